"""Replication catalogue reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.text import same
from eventloom.operators.lookup import in_order, join_on


def replication_topology(state: Mapping[str, DataFrame], ordered: bool = True) -> DataFrame:
    """Which publisher sends which publication to which subscriber.

    The answer is distinct, and a log-reader agent only has to exist, so each input is reduced
    to distinct narrow rows and the agents become a semi-join: no pair of rows is ever formed
    just to be removed again.
    """
    agents = state["logreader_agents"].select("publisher_db").distinct()
    subscriptions = (
        state["subscriptions"].select("publisher_db", "publication_id", "subscriber_id", "subscriber_db").distinct()
    )
    publications = state["publications"].select("publication_id", "publisher_id", "publication").distinct()
    servers = state["replservers"].select("srvid", "srvname").distinct()
    rows = join_on(subscriptions, agents, {"publisher_db": "publisher_db"}, "left_semi")
    rows = join_on(rows, publications, {"publication_id": "publication_id"}, "inner")
    rows = join_on(rows, servers.withColumnRenamed("srvname", "SubscriberServer"), {"subscriber_id": "srvid"}, "inner")
    rows = join_on(rows, servers.withColumnRenamed("srvname", "PublisherServer"), {"publisher_id": "srvid"}, "inner")
    out = rows.select("PublisherServer", "publisher_db", "publication", "subscriber_db", "SubscriberServer").distinct()
    return in_order(out, ordered, "PublisherServer", "publisher_db", "publication")


def articles_per_publication(articles: DataFrame, publications: DataFrame) -> DataFrame:
    """Articles counted per publication name; publications of one name count together."""
    counts = articles.groupBy("publication_id").agg(F.count("article").alias("n"))
    named = join_on(
        counts, publications.select("publication_id", "publication"), {"publication_id": "publication_id"}, "inner"
    )
    return named.groupBy(F.col("publication").alias("Publication")).agg(F.sum("n").alias("CountofName"))


def publication_flags(publications: DataFrame) -> DataFrame:
    first = ["immediate_sync", "allow_anonymous"]
    return publications.select(*first, *[c for c in publications.columns if c not in first])


def snapshot_agent(agents: DataFrame, publication: str, publisher_db: str) -> DataFrame:
    """The snapshot job of a publication."""
    rows = agents.where(same(F.col("publication"), publication) & same(F.col("publisher_db"), publisher_db))
    return rows.select("name")
