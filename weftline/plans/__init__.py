"""Named queries over the test tables; importing the package fills the registry."""

from weftline.plans import cells, files, graph, learn, recommend, relational, streams  # noqa: F401
from weftline.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
