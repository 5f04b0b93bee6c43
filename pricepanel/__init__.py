"""pricepanel: a Spark-native engine for parcel land-price panels.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from
built-in Column expressions so Catalyst can prune, push down and codegen
the whole plan. Python workers appear only in the archive readers
(``sources.archives``), where ZIP members must be inflated.
"""

from pricepanel.session import build_session, work_dir

__all__ = ["build_session", "work_dir"]
