from citylake.functions.columns import *  # noqa: F401,F403
from citylake.functions.columns import WEATHER_CATEGORIES  # noqa: F401
