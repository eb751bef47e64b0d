"""docrank: document relevance (TF-IDF) on Spark DataFrames."""

from docrank.plans.model import FLAVORS, Flavor, TfIdf
from docrank.session import local_session
from docrank.sinks.index import write_index
from docrank.sources.index import Index, read_index

__all__ = ["TfIdf", "Flavor", "FLAVORS", "Index", "read_index", "write_index", "local_session"]
