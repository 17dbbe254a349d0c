"""Mutual links and connected components of a page link graph, on Spark.

Importing the package starts no session, reads nothing and prints nothing.
"""

from linkloom.plans.components import Components, connected_components
from linkloom.plans.job import JobResult, read_results, run_job
from linkloom.plans.mutual import mutual_link_steps, mutual_links
from linkloom.sources.tables import LinkTables, load_tables, tables_from_catalog
from linkloom.sources.workspace import scope

__all__ = [
    "Components",
    "JobResult",
    "LinkTables",
    "connected_components",
    "load_tables",
    "mutual_link_steps",
    "mutual_links",
    "read_results",
    "run_job",
    "scope",
    "tables_from_catalog",
]
