"""visitlens: shop and course behaviour analytics as PySpark DataFrame jobs.

Batch jobs live in ``visitlens.plans``, reusable analytic operators in
``visitlens.operators``, column helpers and predicates in
``visitlens.functions``, inputs in ``visitlens.sources``, table writers in
``visitlens.sinks`` and Structured Streaming jobs in ``visitlens.streaming``.
"""

from visitlens.params import TaskParams
from visitlens.session import build_session, configure, checkpoint_dir

__all__ = ["TaskParams", "build_session", "configure", "checkpoint_dir"]
