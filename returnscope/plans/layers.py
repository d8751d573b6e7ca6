"""The layered build: raw -> staging -> dimensions -> facts -> labelled facts.

``Warehouse`` wires the operators together once and hands the same logical
plans to every analysis, so Catalyst sees one plan per query (no hops through
Python).  The small lookup dimensions are written once, so that the planner
knows their exact size; ``write_layers`` persists every layer as parquet
(a build that replaces the one before in one step), which is how the layers are shared between jobs on a cluster.
"""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import dims, facts, marts, staging
from ..sources import driver, versions
from ..sources.files import materialize, write_table


class Warehouse:
    def __init__(
        self,
        users_raw: DataFrame,
        orders_raw: DataFrame,
        events_raw: DataFrame,
        comments: DataFrame | None = None,
        params: C.Params = C.Params(),
    ):
        self.users_raw = users_raw
        self.orders_raw = orders_raw
        self.events_raw = events_raw
        self.comments_raw = comments
        self.params = params

    @classmethod
    def from_driver(cls, spark: SparkSession, sf_dir: str, params: C.Params = C.DRIVER_PARAMS) -> "Warehouse":
        return cls(
            driver.users_raw(spark, sf_dir),
            driver.orders_raw(spark, sf_dir),
            driver.events_raw(spark, sf_dir),
            driver.comments_raw(spark, sf_dir),
            params,
        )

    @classmethod
    def from_layers(cls, spark: SparkSession, root: str, params: C.Params = C.DRIVER_PARAMS) -> "Warehouse":
        """A warehouse whose staging, dimension and fact layers are the parquet
        tables of the newest finished build of ``write_layers`` (scans get exact file statistics,
        so the tiny dimensions are broadcast by the planner's own size check)."""
        base = versions.current(spark, root)
        if base is None:
            raise FileNotFoundError(f"no finished build under {root}")

        def read(name):
            reader = spark.read.schema(FACT_SCHEMAS[name]) if name in FACT_SCHEMAS else spark.read
            return reader.parquet(os.path.join(base, name))

        try:
            comments = read("stg/comments")
        except AnalysisException:  # layers written without comments
            comments = None
        w = cls(None, None, None, comments, params)
        for attr, name in LAYER_TABLES.items():
            w.__dict__[attr] = read(name)
        return w

    def _spark(self) -> SparkSession:
        for df in (self.users_raw, self.orders_raw, self.comments_raw):
            if df is not None:
                return df.sparkSession
        return self.__dict__["orders"].sparkSession

    # staging
    @cached_property
    def users(self) -> DataFrame:
        return staging.stg_users_clean(self.users_raw)

    @cached_property
    def orders(self) -> DataFrame:
        return staging.stg_orders_clean(self.orders_raw)

    @cached_property
    def events(self) -> DataFrame:
        return staging.stg_events_clean(self.events_raw)

    # dimensions
    @cached_property
    def dim_user(self) -> DataFrame:
        return dims.dim_user(self.users)

    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.dim_date(self.users, self.events)

    @cached_property
    def dim_order_status(self) -> DataFrame:
        return materialize(dims.dim_order_status(self.orders), "dim-order-status")

    @cached_property
    def dim_event_name(self) -> DataFrame:
        return materialize(dims.dim_event_name(self.events), "dim-event-name")

    # facts
    @cached_property
    def fact_orders(self) -> DataFrame:
        return facts.fact_orders(self.orders, self.dim_order_status)

    @cached_property
    def fact_events(self) -> DataFrame:
        return facts.fact_events(self.events, self.dim_event_name)

    @cached_property
    def orders_labelled(self) -> DataFrame:
        return facts.label_orders(self.fact_orders, self.dim_order_status)

    @cached_property
    def events_labelled(self) -> DataFrame:
        return facts.label_events(self.fact_events, self.dim_event_name)

    def layers(self, with_marts: bool = False) -> dict[str, DataFrame]:
        out = {name: getattr(self, attr) for attr, name in LAYER_TABLES.items()}
        if self.comments_raw is not None:
            out["stg/comments"] = self.comments_raw
        if with_marts:
            out["marts/marts_kpi_daily"] = marts.marts_kpi_daily(self.orders_labelled, self.events_labelled)
            out["marts/marts_segments"] = marts.marts_segments(self.orders_labelled, self.dim_user)
        return out

    def write_layers(
        self,
        root: str,
        with_marts: bool = False,
        cluster_facts: bool = True,
        parallel: bool = True,
        comment_partitions: int | None = None,
    ) -> dict[str, str]:
        """Persist every layer as a new build under ``root``, level by level:
        staging, dimensions, facts (and the marts when asked).  The build becomes
        current once all its tables are written (``sources.versions``); until then,
        and if it fails, readers keep the build before.  Ids of the lookup
        dimensions are those of the build before, new names are numbered above
        them.  Returns the path of each table.  After each write
        the warehouse reads the written table, so a layer is built from the
        stored layers below it and the lineage is cut at every layer.  The
        tables of one level do not depend on each other and are written as
        concurrent Spark jobs (``parallel``).

        With ``cluster_facts`` the fact tables are stored in one folder per
        status or event name, range-partitioned and sorted by time inside: an
        analysis of one or two event names reads their folders only (dynamic
        partition pruning through the lookup map), and date windows skip files
        and row groups through parquet min / max statistics.  A hot name spreads
        over as many tasks as its rows ask for (ties split by a second column
        and a random key).

        ``comment_partitions`` deals the comments out to that many files, for
        comments that come as a single split."""
        spark = self._spark()
        before, build = versions.current(spark, root), versions.begin(spark, root)
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        levels = [list(level) for level in LAYER_LEVELS]
        if self.comments_raw is not None:
            levels[0].append("comments_raw")
        names = dict(LAYER_TABLES, comments_raw="stg/comments")
        out, schemas = {}, {}

        def write(attr: str) -> tuple[str, str]:
            lookup = attr in LOOKUPS and attr not in self.__dict__  # numbered and written once, here
            stored = spark.read.parquet(os.path.join(before, names[attr])) if lookup and before else None
            df = LOOKUPS[attr](self, stored) if lookup else getattr(self, attr)
            by = []
            if attr == "comments_raw":
                df = df.repartition(comment_partitions) if comment_partitions else df
            elif cluster_facts and attr in FACT_CLUSTERING:
                # a seeded random last key splits rows equal on every column
                by = FACT_CLUSTERING[attr][:1]
                keys = [*FACT_CLUSTERING[attr], "_tie"]
                df = (
                    df.withColumn("_tie", F.rand(17))
                    .repartitionByRange(parts, *keys)
                    .sortWithinPartitions(*keys)
                    .drop("_tie")
                )
            path = os.path.join(build, names[attr])
            schemas[attr] = df.schema
            write_table(df, path, by)
            return attr, path

        for level in levels:
            for attr in level:  # build the plans on this thread, run them below
                if attr not in LOOKUPS:
                    getattr(self, attr)
            if parallel and len(level) > 1:
                with ThreadPoolExecutor(max_workers=len(level)) as pool:
                    done = list(pool.map(write, level))
            else:
                done = [write(attr) for attr in level]
            for attr, path in done:
                out[names[attr]] = path
                # by the schema: a table in folders per id that has no row has no file either
                self.__dict__[attr] = spark.read.schema(schemas[attr]).parquet(path).select(*schemas[attr].names)
            for derived in ("orders_labelled", "events_labelled"):
                self.__dict__.pop(derived, None)
        if with_marts:
            for name, df in self.layers(with_marts=True).items():
                if name.startswith("marts/"):
                    path = os.path.join(build, name)
                    write_table(df, path)
                    out[name] = path
        versions.commit(spark, build)
        return out


# Lookup dimensions, unwritten: write_layers stores them itself.
LOOKUPS = {
    "dim_order_status": lambda w, stored: dims.dim_order_status(w.orders, stored),
    "dim_event_name": lambda w, stored: dims.dim_event_name(w.events, stored),
}

# Fact tables when written clustered: folder column, then range / sort keys.
FACT_CLUSTERING = {
    "fact_orders": ("status_id", "order_date", "order_id"),
    "fact_events": ("event_name_id", "event_date", "user_id"),
}

# Schemas of the facts, which have no file (only folders) while they have no row.
FACT_SCHEMAS = {
    "fact/fact_orders": "order_id string, user_id int, order_date timestamp_ntz, amount decimal(8,2), status_id int",
    "fact/fact_events": "user_id int, event_date timestamp_ntz, event_name_id int",
}

# Levels of the layer build: the tables of a level depend only on lower levels.
LAYER_LEVELS = (
    ("users", "orders", "events"),
    ("dim_user", "dim_date", "dim_order_status", "dim_event_name"),
    ("fact_orders", "fact_events"),
)

# Warehouse attribute -> table path under the layer root, in build order.
LAYER_TABLES = {
    "users": "stg/stg_users_clean",
    "orders": "stg/stg_orders_clean",
    "events": "stg/stg_events_clean",
    "dim_user": "dim/dim_user",
    "dim_date": "dim/dim_date",
    "dim_order_status": "dim/dim_order_status",
    "dim_event_name": "dim/dim_event_name",
    "fact_orders": "fact/fact_orders",
    "fact_events": "fact/fact_events",
}
