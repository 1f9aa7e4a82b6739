"""Plan-level building blocks shared by the operators."""

from presswork.plans.lookup import lookup_join
from presswork.plans.ordering import global_rank, running_sums
from presswork.plans.stage import staged

__all__ = ["global_rank", "lookup_join", "running_sums", "staged"]
