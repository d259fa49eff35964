from canton.workload import basics, crosswalks, experiments, files, landing, profiles, stars, votes  # noqa: F401
from canton.workload.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
