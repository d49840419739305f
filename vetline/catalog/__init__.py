from vetline.catalog import composites, files, records, scalars  # noqa: F401  (they register their queries)
from vetline.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
