"""A query as a source: run locally, or pushed down to a remote database.

Locally the text becomes a derived table of ``spark.sql``.  Remotely it
is handed to the JDBC source (``query`` option), so the remote database
runs it and Spark reads only its result; a text that does not start with
``SELECT`` is taken as a table name and wrapped in ``SELECT * FROM``.
Routing through an intermediate proxy server is network configuration
and is not rebuilt; give the JDBC URL the proxy would reach.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def _bare(name: str | None) -> str | None:
    if name is None:
        return None
    return name.replace("[", "").replace("]", "").replace('"', "")


def is_remote(server: str | None, local_name: str | None = None) -> bool:
    """A server other than this one (``local_name``) is remote."""
    s = _bare(server)
    return s is not None and s != _bare(local_name)


def remote_text(query: str) -> str:
    """The text sent to a remote server (a bare name becomes a SELECT)."""
    return query if query.lstrip()[:6].upper() == "SELECT" else f"SELECT * FROM {query}"


def from_clause(query: str, server: str | None = None, local_name: str | None = None) -> str:
    """The FROM-clause form of a query: a derived table, or a pass-through text."""
    if is_remote(server, local_name):
        quoted = remote_text(query).replace("'", "''")
        return f"OPENQUERY([{_bare(server)}], '{quoted}')"
    return f"({query})"


def remote_query(
    spark: SparkSession,
    query: str,
    server: str | None = None,
    jdbc: Mapping[str, str] | None = None,
    local_name: str | None = None,
    **frames: DataFrame,
) -> DataFrame:
    """A DataFrame over ``query``: local SQL, or a JDBC pass-through query.

    Locally, ``frames`` bind ``{name}`` placeholders of the text to
    DataFrames (no session-wide views needed).  ``jdbc`` holds the JDBC options of ``server`` (``url``, ``driver``,
    credentials, ``fetchsize``...).  Spark plans the result as a scan, so
    filters and projections applied afterwards are pushed into the
    remote query where the dialect allows.
    """
    if not is_remote(server, local_name):
        return spark.sql(f"SELECT * FROM {from_clause(query)} AS q", **frames)
    if not jdbc or "url" not in jdbc:
        raise ValueError(f"no JDBC connection given for server {_bare(server)}")
    return spark.read.format("jdbc").options(**jdbc).option("query", remote_text(query)).load()
