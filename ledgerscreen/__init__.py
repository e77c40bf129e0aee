"""Spark-native general-ledger screening.

Clean -> six audit rules -> Benford digit screen -> distributed isolation forest
-> blended risk score -> label validation -> report and dashboard tables, all as
DataFrame / Spark SQL plans.
"""

from ledgerscreen.params import Params, DEFAULT_PARAMS
from ledgerscreen.session import get_session, checkpoint_dir

__all__ = ["Params", "DEFAULT_PARAMS", "get_session", "checkpoint_dir"]
