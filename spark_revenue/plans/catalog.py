"""All registered queries and their SQL counterparts."""

from . import jobs_analysis, jobs_kpi, jobs_marts, jobs_quality, jobs_storage  # noqa: F401  (each registers its queries)
from .oracle_analysis import ANALYSIS
from .oracle_kpi import KPI
from .oracle_marts import MARTS
from .oracle_model import MODEL
from .oracle_quality import QUALITY
from .oracle_storage import STORAGE
from .registry import JOBS, run

ORACLE: dict[str, str] = {**KPI, **QUALITY, **ANALYSIS, **MARTS, **MODEL, **STORAGE}

__all__ = ["JOBS", "ORACLE", "run"]
