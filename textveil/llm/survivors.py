"""Best representative of each duplicate group, by currency reasoning.

Which status follows which is learned from groups whose rows carry timestamps;
it orders the rows that lack them.  Every step is an aggregate with partial
sums, so a group that holds a third of all rows is no hot spot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textveil.llm.keys import filled, hex_id, label
from textveil.session import cut

#: Trust of a status, best first; all others and null come last.
TRUST = (("final", "amended", "corrected"), ("preliminary", "partial", "registered"))
#: Most statuses; more of them raise, as their order is worked out on the driver.
MAX_VALUES = 10_000
FIELDS = ("per_number", "text", "modality", "site", "lang")


def learn_precedence(rows: DataFrame, group: str, value: str, at: str, min_support: int = 3) -> list[str]:
    """Values of ``value`` in the order in which they follow each other.

    ``u`` precedes ``v`` where, over groups with timestamps on both, the last
    ``u`` is more often before the last ``v`` than after it.  Edges are taken
    strongest first and skipped where they would close a cycle; the result is a
    topological order of the values (ties by name).  Null values, groups and
    timestamps teach nothing.
    """
    common = [r[0] for r in rows.where(F.col(value).isNotNull()).select(value).distinct().orderBy(value).limit(MAX_VALUES + 1).collect()]
    if len(common) > MAX_VALUES:
        raise ValueError(f"more than {MAX_VALUES} values of {value}")
    last = rows.where(F.col(group).isNotNull() & F.col(at).isNotNull() & F.col(value).isNotNull()).groupBy(group, value).agg(F.max(at).alias("t"))
    u = last.select(group, F.col(value).alias("u"), F.col("t").alias("tu"))
    v = last.select(group, F.col(value).alias("v"), F.col("t").alias("tv"))
    seen = u.join(v, group).where("u <> v and tu < tv").groupBy("u", "v").count().collect()  # pairs of statuses, not of rows
    n = {(r["u"], r["v"]): r["count"] for r in seen}
    edges = sorted(((c - n.get((b, a), 0), a, b) for (a, b), c in n.items() if c >= min_support and c > n.get((b, a), 0)), key=lambda e: (-e[0], e[1], e[2]))
    after: dict[str, set] = {x: set() for x in common}

    def reaches(a: str, b: str) -> bool:
        todo, done = [a], set()
        while todo:
            x = todo.pop()
            if x == b:
                return True
            if x not in done:
                done.add(x)
                todo += after[x]
        return False

    for _, a, b in edges:
        if not reaches(b, a):
            after[a].add(b)
    indegree = {x: sum(x in s for s in after.values()) for x in common}
    order, ready = [], sorted(x for x in common if not indegree[x])
    while ready:
        x = ready.pop(0)
        order.append(x)
        for y in after[x]:
            indegree[y] -= 1
            if not indegree[y]:
                ready.append(y)
        ready.sort()
    return order


def survivors(rows: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """One record per report with two or more rows.

    Columns: ``report_id``, ``report_row_id`` (the leading row), ``n_rows``,
    ``currency_row_id`` (the topologically latest row of the best trust) and,
    for each field, ``<field>_from``: the id of the row that the field's value
    is taken from, null where no row has one.

    The leading row has the best status, then the latest issued_at (nulls
    last), then the most filled fields, then the smallest id.  A field comes
    from the best row that has it: by trust, then by currency, then as above.
    Currency is issued_at; a row without it stands where the learned order of
    statuses puts it: behind the rows of its report whose status precedes its
    own, before the others.  Rows without a report id form no group; repeated
    rows are rows; an empty table gives an empty result; other columns of
    ``rows`` are not looked at.
    """
    status = label(F.col("status"))
    trust = F.when(status.isin(*TRUST[0]), 0).when(status.isin(*TRUST[1]), 1).otherwise(2)
    slim = rows.select(
        hex_id(F.col("diagnostic_report_id")).alias("report_id"),
        F.col("report_row_id"),
        status.alias("status"),
        trust.alias("trust"),
        F.unix_micros(F.col("issued_at").cast("timestamp")).alias("at"),
        *[filled(F.col(f)).alias(f"has_{f}") for f in fields],
    ).where("report_id is not null")
    slim = cut(slim.withColumn("n_filled", sum((F.col(f"has_{f}").cast("int") for f in fields), F.lit(0))))
    order = learn_precedence(slim, "report_id", "status", "at")
    rank = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for i, s in enumerate(order) for x in (s, i)]), F.col("status")), F.lit(-1)) if order else F.lit(-1)
    slim = slim.withColumn("rank", rank)

    # latest time of each status of a report: bounded by the number of statuses
    by_rank = slim.where("at is not null").groupBy("report_id", "rank").agg(F.max("at").alias("last"))
    missing = slim.where("at is null").select("report_id", F.col("rank").alias("own")).distinct()
    placed = missing.join(by_rank, "report_id").where("rank < own").groupBy("report_id", "own").agg((F.max("last") + 1).alias("inferred")).withColumnRenamed("own", "rank")
    slim = slim.join(placed, ["report_id", "rank"], "left").withColumn("inferred", F.when(F.col("at").isNull(), F.col("inferred")))
    lead = [F.col("trust"), -F.coalesce("at", F.lit(-(2**62))), -F.col("n_filled"), F.col("report_row_id")]
    current = [F.col("trust"), -F.coalesce("at", "inferred", F.lit(-(2**62))), -F.col("rank"), -F.col("n_filled"), F.col("report_row_id")]
    named = lambda cols: F.struct(*[c.alias(f"k{i}") for i, c in enumerate(cols)])
    agg = slim.groupBy("report_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(named(lead)).alias("lead"),
        F.min(named(current)).alias("current"),
        *[F.min(F.when(F.col(f"has_{f}"), named(current))).alias(f"of_{f}") for f in fields],
    )
    return agg.where("n_rows > 1").select("report_id", F.col("lead.k3").alias("report_row_id"), "n_rows", F.col("current.k4").alias("currency_row_id"), *[F.col(f"of_{f}.k4").alias(f"{f}_from") for f in fields])


def fuse(rows: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """The surviving records with their values: :func:`survivors` joined back.

    ``status`` and ``issued_at`` come from the leading row, every other field
    from its own best row (null where no row has one).
    """
    chosen = survivors(rows, fields)
    takes = chosen.select("report_id", "n_rows", F.explode(F.map_filter(F.create_map(*[x for f in ("lead", *fields) for x in (F.lit(f), F.col("report_row_id" if f == "lead" else f"{f}_from"))]), lambda _, v: v.isNotNull())).alias("field", "row_id"))
    values = takes.join(rows.select(F.col("report_row_id").alias("row_id"), "status", "issued_at", *fields), "row_id")
    return values.groupBy("report_id").agg(
        F.first("n_rows").alias("n_rows"),
        F.max(F.when(F.col("field") == "lead", F.col("row_id"))).alias("report_row_id"),
        F.max(F.when(F.col("field") == "lead", F.col("status"))).alias("status"),
        F.max(F.when(F.col("field") == "lead", F.col("issued_at"))).alias("issued_at"),
        *[F.max(F.when(F.col("field") == f, F.col(f))).alias(f) for f in fields],
    )
