"""All registered queries; importing this package fills the registry."""

from . import datasets, expressions, groups, joins, quality, reports, scans, windows
from .registry import QUERIES

__all__ = ["QUERIES", "datasets", "expressions", "groups", "joins", "quality", "reports", "scans", "windows"]
