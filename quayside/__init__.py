"""Quayside: land data in a lake on Spark, protect it, check it and keep the record of every run."""

from quayside.session import build_session, durable, run_folder

__all__ = ["build_session", "durable", "run_folder"]
