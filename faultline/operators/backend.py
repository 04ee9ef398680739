"""What was known about an error's request, server and earlier actions when it happened.

Three tables meet the errors: requests by id, servers by name *and time* (facts hold until the next facts of the server), and
crumbs within the request. Each is one shuffle on its key; none is a join of all pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions import crumbs as C
from faultline.functions import http, privacy, stack
from faultline.operators.normalize import request_context, user_context
from faultline.operators.skew import LONE, MAX_ROWS, SLICE, Heat, as_keys, by_heat, join_carry, lone_keys
from faultline.operators.trails import MAX_CRUMBS, attach_breadcrumbs

# The server facts that a record carries, in this order.
SERVER_FACTS = ("php_version", "php_sapi", "symfony_version", "server_name", "os", "server_software", "server_product",
                "server_version", "server_protocol", "https")
REQUEST_FACTS = ("url", "method", "query", "headers", "data", "cookies", "ip", "host", "port", "uri", "user_agent")


def as_of(
    rows: DataFrame, facts: DataFrame, keys: str | Sequence[str], valid_from: str = "valid_from", name: str = "facts",
    ts: str = "ts", heat: Heat = MAX_ROWS,
) -> DataFrame:
    """The facts of each row's key that were valid at its time, as the struct ``name``.

    Facts hold from ``valid_from`` (that instant included) until the key's next ones. Rows before the first facts, without a
    key or without a time get null; of facts of one instant those with the greatest hash of their columns hold. One pass
    over the merged timeline; slices of a hot key get the last facts of the slices before as a carry.
    """
    asked = as_keys(keys)
    fact = F.struct(*facts.columns)
    rows, facts, keys = lone_keys(rows, facts.filter(F.col(valid_from).isNotNull()), asked)
    left = rows.select(*keys, F.col(ts).alias("_at"), F.struct(*rows.columns).alias("_row"), F.lit(None).alias("_fact"), F.lit(1).alias("_kind"))
    right = facts.select(*keys, F.col(valid_from).alias("_at"), F.lit(None).alias("_row"), fact.alias("_fact"), F.lit(0).alias("_kind"))
    line = left.unionByName(right).withColumn("_tie", F.xxhash64("_fact"))

    def plain(d: DataFrame, ks: list[str]) -> DataFrame:
        w = Window.partitionBy(*ks).orderBy(F.col("_at").asc_nulls_first(), "_kind", "_tie").rowsBetween(Window.unboundedPreceding, 0)
        return d.withColumn("_held", F.last("_fact", ignorenulls=True).over(w))

    def finish(d: DataFrame) -> DataFrame:
        return d.filter(F.col("_row").isNotNull()).select("_row.*", F.col("_held").alias(name))

    def sliced(d: DataFrame, ks: list[str]) -> DataFrame:
        ends = d.groupBy(*ks, SLICE).agg(F.max_by("_fact", F.when(F.col("_fact").isNotNull(), F.struct("_at", "_tie"))).alias("_last"))
        before = Window.partitionBy(*ks).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        carry = ends.select(*ks, SLICE, F.last("_last", ignorenulls=True).over(before).alias("_carried"))
        d = join_carry(plain(d, [*ks, SLICE]), carry, ks)
        return finish(d.withColumn("_held", F.coalesce("_held", "_carried")))

    out = by_heat(line, keys, lambda d, ks: finish(plain(d, ks)), sliced, "_at", heat)
    return out if LONE in asked else out.drop(LONE)


def server_facts(facts: str, name: str = "server_name") -> Column:
    """The server part of a record from a facts struct (null: only the row's own server name is known)."""
    f = lambda x, kind="string": F.coalesce(F.col(f"{facts}.{x}"), F.lit(None).cast(kind))
    software = http.server_software(f("server_software"))
    return F.struct(
        f("php_version").alias("php_version"), f("php_sapi").alias("php_sapi"), f("symfony_version").alias("symfony_version"),
        F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit(stack.UNKNOWN)).alias("server_name"), f("os").alias("os"),
        f("server_software").alias("server_software"), software["product"].alias("server_product"),
        software["version"].alias("server_version"), f("server_protocol").alias("server_protocol"),
        http.https_flag(f("https")).alias("https"))


def request_trail(
    rows: DataFrame, crumbs: DataFrame, captured: DataFrame | None = None, n: int = MAX_CRUMBS, heat: Heat = MAX_ROWS,
) -> DataFrame:
    """``breadcrumbs``: the last ``n`` crumbs of each row's request, oldest first.

    ``crumbs`` has ``request_id, event_id, ts, level, type, category, message, data``. Each exception of ``captured``
    (``request_id, event_id, ts, message``) leaves a crumb too, once it has been captured: later rows of the request see it
    from the next microsecond on, its own record does not. Rows without a request have an empty trail.
    """
    item = F.struct(F.col("ts").alias("timestamp"), "level", "type", "category", "message", "data")
    if captured is not None:
        left = captured.select("request_id", "event_id", "ts", C.exception_breadcrumb(F.col("ts"), F.coalesce("message", F.lit(""))).alias("c"))
        left = left.select("request_id", "event_id", F.expr("ts + INTERVAL 1 MICROSECOND").alias("ts"), "c.level", "c.type", "c.category", "c.message", "c.data")
        crumbs = crumbs.select(*left.columns).unionByName(left)
        # The crumb bears the time of the capture.
        own = F.when((F.col("type") == "error") & (F.col("category") == "exception"), F.expr("ts - INTERVAL 1 MICROSECOND")).otherwise(F.col("ts"))
        item = F.struct(own.alias("timestamp"), "level", "type", "category", "message", "data")
    return attach_breadcrumbs(rows, crumbs, "request_id", n, item, heat)


def with_context(
    rows: DataFrame, requests: DataFrame, servers: DataFrame, crumbs: DataFrame | None = None, captured: DataFrame | None = None,
    n: int = MAX_CRUMBS, scrub_fields: Sequence[str] = privacy.BACKEND_FIELDS, heat: Heat = MAX_ROWS,
) -> DataFrame:
    """Exceptions or log rows with ``request``, ``user``, ``server``, ``session_hash`` and ``breadcrumbs``.

    ``rows`` have ``event_id, ts, request_id, server_name``; ``requests`` one row a request with ``request_id``, the columns
    of ``REQUEST_FACTS``, ``has_session``, ``session_id`` and ``app_session_id``; ``servers`` have ``server_name``,
    ``valid_from`` and their facts. Request and user are null outside of a request, the hash without a session.
    """
    rows = as_of(rows, servers, "server_name", name="_facts", heat=heat)
    if crumbs is not None:
        rows = request_trail(rows, crumbs, captured, n, heat)
    known = requests.select(
        "request_id", F.when(F.col("url").isNotNull(), request_context(scrub_fields)).alias("request"),
        F.when(F.col("has_session"), user_context()).alias("user"),
        privacy.session_hash(F.when(F.col("has_session"), F.col("app_session_id"))).alias("session_hash"))
    rows = rows.join(known, "request_id", "left").withColumn("server", server_facts("_facts"))
    return rows.drop("_facts")
