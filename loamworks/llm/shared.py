"""The shared folder, cut-off points for lineage, and the batch size of queries here."""

from ..session import tuned
from ..storage import landed, shared_dir

__all__ = ["landed", "shared_dir", "tuned"]
