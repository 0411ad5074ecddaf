from citylake.operators.dedup import latest_per_key  # noqa: F401
from citylake.operators.joins import bounded, lookup_join  # noqa: F401
