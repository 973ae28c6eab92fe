"""All registered queries of the library, without those of the training-data subpackage."""

from skeinwork.plans import changes, documents, places, relational, scalars  # noqa: F401
from skeinwork.plans.registry import COVERS, ORACLE, QUERIES

__all__ = ["COVERS", "ORACLE", "QUERIES"]
