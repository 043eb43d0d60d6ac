"""Splits that keep all records of one person together.

A component table ``(node, root)`` is kept between runs.  New links are merged
into it by hooking roots onto smaller roots and shortening the chains by
pointer jumping; every round cuts its lineage in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textveil.llm.keys import hex_id, label, person_number, phase
from textveil.session import cut

#: Default proportions of the new split.
PROPORTIONS = {"train": 0.7, "validation": 0.1, "test": 0.2}
#: Components above this share of the open rows are placed one by one, largest
#: first; there are fewer than 1 / BIG_SHARE of them, whatever the input.
BIG_SHARE = 0.01
#: Blocks of the prefix sum over components; the driver sees one sum of each.
BLOCKS = 256


def merge_components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Components of the graph ``links(a, b)``, as ``(node, root)``.

    ``known`` is the ``(node, root)`` of an earlier run: its components are the
    starting point, so only links between different roots cost work.  The root
    is the smallest node.  Null ends and loops are ignored (a loop still makes
    its node a component); repeated links count once; an empty table gives an
    empty result.
    """
    links = links.select("a", "b").where("a is not null and b is not null").distinct()
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    if known is not None:
        nodes = nodes.join(known.select("node", "root"), "node", "full").select("node", F.coalesce("root", "node").alias("root"))
    else:
        nodes = nodes.select("node", F.col("node").alias("root"))
    labels = cut(nodes)
    edges = cut(links.where("a <> b"))
    while True:
        # edges between roots; the larger root hooks onto the smallest neighbour
        r = labels.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        s = labels.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = edges.join(r, "a").join(s, "b").where("ra <> rb").select(F.greatest("ra", "rb").alias("a"), F.least("ra", "rb").alias("b")).distinct()
        edges = cut(edges)
        hooks = cut(edges.groupBy(F.col("a").alias("child")).agg(F.min("b").alias("parent")))
        if hooks.isEmpty():
            return labels
        while True:  # pointer jumping: parent := parent of the parent
            up = hooks.select(F.col("child").alias("parent"), F.col("parent").alias("above"))
            jumped = cut(hooks.join(up, "parent", "left").select("child", F.coalesce("above", "parent").alias("parent"), F.col("above").isNotNull().alias("moved")))
            moved = not jumped.where("moved").isEmpty()
            hooks = jumped.drop("moved")
            if not moved:
                break
        labels = cut(labels.join(hooks.select(F.col("child").alias("root"), "parent"), "root", "left").select("node", F.coalesce("parent", "root").alias("root")))


def person_links(rows: DataFrame, lookup: DataFrame, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(keyed, links)``: each row of ``rows`` with its node, and what ties nodes.

    A node is ``n`` and a per_number in 18 digits, or ``h`` and a FHIR id.  Ties
    are patient_lookup (id, number) and, for a row's document, the number of
    resource_mapping.  A row without patient_id takes its document's number.
    """
    number = lambda c: F.concat(F.lit("n"), F.lpad(person_number(c).cast("string"), 18, "0"))
    fhir = lambda c: F.concat(F.lit("h"), hex_id(c))
    rows = rows.select(
        "split_id",
        F.coalesce(fhir(F.col("patient_id")), number(F.col("patient_id"))).alias("node"),
        hex_id(F.regexp_replace("document_id", r"(?i)\.[a-z]{1,5}\s*$", "")).alias("document"),
        phase(F.col("phase")).alias("phase"),
        label(F.col("document_type")).alias("document_type"),
    )
    of_doc = mapping.select(hex_id(F.col("id")).alias("document"), number(F.col("per_number")).alias("number")).where("document is not null and number is not null").distinct()
    first = of_doc.groupBy("document").agg(F.min("number").alias("first_number"))
    keyed = rows.join(first, "document", "left").withColumn("node", F.coalesce("node", "first_number")).drop("first_number")
    by_doc = keyed.where("node is not null").select("node", "document").distinct().join(of_doc, "document").select(F.col("node").alias("a"), F.col("number").alias("b"))
    by_lookup = lookup.select(fhir(F.col("id")).alias("a"), number(F.col("identifier_0_value")).alias("b")).where("a is not null and b is not null")
    alone = keyed.where("node is not null").select(F.col("node").alias("a"), F.col("node").alias("b"))
    return keyed, by_doc.union(by_lookup).union(alone).distinct()


def persons(rows: DataFrame, lookup: DataFrame, mapping: DataFrame, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(rows with root and person_no, component table)``.

    ``person_no`` is the smallest per_number of the component (null where it
    has none); rows without any key have a null root: nobody ties them.
    """
    keyed, links = person_links(rows, lookup, mapping)
    keyed = cut(keyed)
    components = merge_components(cut(links), known)
    numbers = components.where("node like 'n%'").groupBy("root").agg(F.min("node").alias("n")).select("root", F.substring("n", 2, 18).cast("bigint").alias("person_no"))
    out = keyed.join(components, "node", "left").join(numbers, "root", "left")
    return out.select("split_id", "document_type", "phase", "document", "node", "root", "person_no"), components


def split_conflicts(persons_rows: DataFrame) -> DataFrame:
    """Rows with a phase whose person has rows in more than one phase: ``(split_id, person_no)``."""
    mixed = persons_rows.where("phase is not null and root is not null").groupBy("root").agg(F.min("phase").alias("p"), F.max("phase").alias("q")).where("p <> q").select("root")
    return persons_rows.where("phase is not null").join(mixed, "root", "left_semi").select("split_id", "person_no")


def assign_splits(persons_rows: DataFrame, proportions: dict[str, float] | None = None, prior: DataFrame | None = None, components: DataFrame | None = None) -> DataFrame:
    """The new phase of every row: ``(split_id, root, person_no, phase, new_phase, state)``.

    * A component whose rows and whose ``prior`` name one phase keeps it: state
      ``kept``.  ``prior(root, new_phase)`` is what an earlier run gave out; its
      roots are led to the present ones by ``components``, the component table
      of this run, so components keep their split when their root changes.
    * A component with several phases, in its rows or by merging components
      that were split differently before, is in conflict: state
      ``quarantined``.  It loses its phases and is placed like a new one, so
      that no person stays in two phases, and can be left out by its state.
    * Others are ``new`` and fill what each phase still lacks.

    Rows without any key are each their own person.  Deficits are filled by the
    components in a random but fixed order; the few that hold more than
    BIG_SHARE of the open rows go first, each to the phase that lacks most.
    """
    shares = proportions or PROPORTIONS
    total = sum(shares.values())
    names = list(shares)
    rows = persons_rows.withColumn("root", F.coalesce("root", F.concat(F.lit("r"), F.col("split_id").cast("string"))))
    comp = rows.groupBy("root").agg(F.count(F.lit(1)).alias("size"), F.min("phase").alias("p"), F.max("phase").alias("q"))
    if prior is not None:
        if components is None:
            raise ValueError("prior needs the component table of this run")
        # the root of a row without any key is its own number; the row may have a key by now
        now = components.select("node", "root").union(rows.select(F.concat(F.lit("r"), F.col("split_id").cast("string")), "root")).distinct()
        earlier = prior.select(F.col("root").alias("node"), "new_phase").distinct().join(now, "node")
        comp = comp.join(earlier.groupBy("root").agg(F.min("new_phase").alias("bp"), F.max("new_phase").alias("bq")), "root", "left")
        comp = comp.withColumns({"p": F.least("p", "bp"), "q": F.greatest("q", "bq")}).drop("bp", "bq")
    comp = comp.withColumn("state", F.when(F.col("p") < F.col("q"), "quarantined").when(F.col("p").isNull(), "new").otherwise("kept"))
    comp = comp.withColumn("keeps", F.when(F.col("state") == "kept", F.col("p"))).withColumn("block", F.pmod(F.xxhash64("root"), F.lit(BLOCKS)).cast("int"))
    comp = cut(comp)

    held = {r["keeps"]: r["n"] for r in comp.groupBy("keeps").agg(F.sum("size").alias("n")).collect()}
    rest = held.pop(None, 0)
    n = sum(held.values()) + rest
    lack = {k: max(0.0, shares[k] / total * n - held.get(k, 0)) for k in names}
    open_ = comp.where("keeps is null")
    big_at = max(1.0, BIG_SHARE * rest)
    placed = []
    for r in sorted(open_.where(F.col("size") > big_at).select("root", "size").collect(), key=lambda r: (-r["size"], r["root"])):
        to = max(names, key=lambda k: (lack[k], shares[k]))
        lack[to] = max(0.0, lack[to] - r["size"])
        placed.append((r["root"], to))
    small = open_.where(F.col("size") <= big_at)
    sums = {r["block"]: r["n"] for r in small.groupBy("block").agg(F.sum("size").alias("n")).collect()}
    start, before = 0, {}
    for b in sorted(sums):
        before[b], start = start, start + sums[b]
    scale = start / sum(lack.values()) if sum(lack.values()) else 0.0
    if not scale:
        lack, scale = {k: shares[k] / total for k in names}, float(start)
    offset = F.element_at(F.create_map(*[F.lit(x) for b in sorted(sums) for x in (b, before[b])]), F.col("block")) if sums else F.lit(0)
    within = Window.partitionBy("block").orderBy(F.xxhash64("root", F.lit(7)), "root")
    middle = offset + F.sum("size").over(within) - F.col("size") / 2
    to, edge = F.lit(names[-1]), 0.0
    choice = None
    for k in names[:-1]:
        edge += lack[k] * scale
        choice = F.when(middle < edge, k) if choice is None else choice.when(middle < edge, k)
    to = choice.otherwise(names[-1]) if choice is not None else to
    spark = comp.sparkSession
    chosen = comp.where("keeps is not null").select("root", F.col("keeps").alias("new_phase"), "state").union(small.select("root", to.alias("new_phase"), "state"))
    if placed:
        big = spark.createDataFrame(placed, "root string, new_phase string").join(comp.select("root", "state"), "root")
        chosen = chosen.union(big.select("root", "new_phase", "state"))
    return rows.join(chosen, "root").select("split_id", "root", "person_no", "phase", "new_phase", "state")


def run_batches(batches: list[DataFrame], lookup: DataFrame, mapping: DataFrame, proportions: dict[str, float] | None = None) -> DataFrame:
    """Several deliveries one after the other, each with all rows so far: the
    component table and the phases of one are written, and read by the next.

    The answer is :func:`assign_splits` of the last delivery.
    """
    known = prior = out = None
    for rows in batches:
        placed, components = persons(rows, lookup, mapping, known)
        out = cut(assign_splits(placed, proportions, prior, components if prior is not None else None))
        known, prior = components, out.select("root", "new_phase").distinct()
    return out
