"""starloom: a catalogue-to-star-schema ETL engine on Spark DataFrames."""

from .session import build_session, checkpoint_dir, scale_conf, scratch_path

__all__ = ["build_session", "checkpoint_dir", "scale_conf", "scratch_path"]
