"""Contact-engagement analytics on Spark DataFrames."""

from touchpath.settings import ModelSettings, Settings

__all__ = ["ModelSettings", "Settings"]
