"""rivulet: one set of DataFrame operators for bounded tables and Structured Streaming.

Every operator is a plain ``DataFrame -> DataFrame`` function, so the same code runs on
``spark.read`` and ``spark.readStream`` inputs. Execution is left to Spark (Catalyst,
whole-stage codegen, the state store); this package adds semantics, sinks with
idempotent replay, and the audit/observability jobs around them.
"""

from rivulet.session import build_session, run_dir, work_root

__all__ = ["build_session", "run_dir", "work_root"]
