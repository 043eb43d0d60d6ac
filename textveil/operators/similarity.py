"""Line similarity of documents, and the choice of distinct ones."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textveil.session import cut


def line_terms(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, term, tf)``: lines in lower case, counted."""
    lines = F.filter(F.split(F.lower(F.col(text)), r"[\n\r]+"), lambda x: x != "")
    return df.select(key, F.explode(lines).alias("term")).groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def line_cosine(df: DataFrame, key: str, text: str, min_cosine: float = 0.0) -> DataFrame:
    """``(a, b, cosine)``, a < b, of documents that share a line.

    Every pair comes out, equal documents included; ``class_cosine`` compares
    documents of the same lines once.
    """
    terms = line_terms(df, key, text)
    norm = terms.groupBy(key).agg(F.sqrt(F.sum(F.col("tf") * F.col("tf"))).alias("norm"))
    a = terms.select(F.col(key).alias("a"), "term", F.col("tf").alias("ta"))
    b = terms.select(F.col(key).alias("b"), "term", F.col("tf").alias("tb"))
    dots = a.join(b, "term").where("a < b").groupBy("a", "b").agg(F.sum(F.col("ta") * F.col("tb")).alias("dot"))
    na, nb = norm.select(F.col(key).alias("a"), F.col("norm").alias("na")), norm.select(F.col(key).alias("b"), F.col("norm").alias("nb"))
    return dots.join(na, "a").join(nb, "b").select("a", "b", (F.col("dot") / (F.col("na") * F.col("nb"))).alias("cosine")).where(F.col("cosine") > min_cosine)


def line_classes(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, class, lines)``: documents of the same lines, as often, have one class.

    The class is a digest of the sorted lines, worked out within the row; null
    texts and texts without lines have none.
    """
    lines = F.array_sort(F.filter(F.split(F.lower(F.col(text)), r"[\n\r]+"), lambda x: x != ""))
    return df.select(key, lines.alias("lines")).where(F.size("lines") > 0).select(key, F.sha2(F.concat_ws("\n", "lines"), 256).alias("class"), "lines")


def class_cosine(classes: DataFrame, key: str, min_cosine: float = 0.0) -> DataFrame:
    """``(a, b, cosine)``, a < b, of the classes of ``line_classes`` that share a line.

    ``a`` and ``b`` are the smallest keys of their classes.  Members of a class
    have cosine 1 with one another and the class's cosine with all others.

    Lines are ordered from rare to common.  Two classes above ``min_cosine``
    share one of each one's lines before those whose squares reach no further
    than ``min_cosine``, so only those lines make pairs.
    """
    reps = classes.groupBy("class").agg(F.min(key).alias("c"), F.first("lines").alias("lines"))
    terms = reps.select("c", F.explode("lines").alias("term")).groupBy("c", "term").agg(F.count(F.lit(1)).cast("double").alias("tf"))
    terms = cut(terms)
    norm = terms.groupBy("c").agg(F.sqrt(F.sum(F.col("tf") * F.col("tf"))).alias("norm"))
    common = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    rest = Window.partitionBy("c").orderBy(F.desc("df"), F.desc("term"))
    weighed = terms.join(common, "term").join(norm, "c").select("c", "term", "df", (F.col("tf") / F.col("norm")).alias("w"))
    weighed = cut(weighed.withColumn("behind", F.sum(F.col("w") * F.col("w")).over(rest)))
    makes = weighed.where(F.col("behind") > min_cosine * min_cosine - 1e-9).select("c", "term")
    pairs = makes.withColumnRenamed("c", "a").join(makes.withColumnRenamed("c", "b"), "term").where("a < b").select("a", "b").distinct()
    bag = weighed.groupBy("c").agg(F.map_from_entries(F.collect_list(F.struct("term", "w"))).alias("v"))
    both = pairs.join(bag.select(F.col("c").alias("a"), F.col("v").alias("va")), "a").join(bag.select(F.col("c").alias("b"), F.col("v").alias("vb")), "b")
    dot = F.aggregate(F.map_entries("va"), F.lit(0.0), lambda acc, x: acc + x["value"] * F.coalesce(F.try_element_at("vb", x["key"]), F.lit(0.0)))
    return both.select("a", "b", dot.alias("cosine")).where(F.col("cosine") > min_cosine)


def average_linkage(row: np.ndarray, term: np.ndarray, value: np.ndarray, weight: np.ndarray, k: int) -> np.ndarray:
    """Labels of ``k`` clusters of unit vectors by average linkage of 1 - cosine.

    ``row``, ``term`` and ``value`` are the vectors' entries in any order, without
    terms that only one vector has; ``weight`` counts the texts each vector stands
    for.  Of equal distances the first by row, then by column, is merged (equal to
    36 bits, as sums in other orders differ in their last ones).

    The mean cosine of two clusters is that of their mean vectors, so nothing is
    held but the entries.  Chains of nearest neighbours find the merges, which are
    then put in order: a merged cluster is nowhere nearer than its nearer part, nor
    as near with a smaller place, so each merge is one that plain linkage makes.
    """
    n, terms = len(weight), int(term.max(initial=-1)) + 1
    bags: list[tuple[np.ndarray, np.ndarray]] = []
    name, size, vals = np.arange(n), weight.astype(float), value * weight[row]
    chain: list[int] = []
    edges: list[tuple[float, int, int]] = []  # of the chain: - cosine, smaller place, larger place
    merges: list[tuple[float, int, int]] = []
    live, m = n, 0
    while live > 1:
        if not m or live < 0.8 * m:  # number the clusters anew
            if m:
                left = np.flatnonzero(size)
                place = np.zeros(m, np.int64)
                place[left] = np.arange(live)
                row = np.repeat(np.arange(live), [len(bags[x][0]) for x in left])
                term, vals = (np.concatenate([bags[x][part] for x in left]) for part in (0, 1))
                name, size = name[left], size[left]
                chain = [int(place[x]) for x in chain]
                edges = [(s, int(place[i]), int(place[j])) for s, i, j in edges]
            m = live
            order = np.argsort(row * terms + term)
            bounds = np.searchsorted(row[order], np.arange(1, m))
            bags = list(zip(np.split(term[order], bounds), np.split(vals[order], bounds)))
            # lines that many clusters have as rows, the others as lists of clusters
            held = np.bincount(term, minlength=terms)
            most_held = np.argsort(-held, kind="stable")[:64]
            most_held = most_held[held[most_held] * 20 > m]
            rank = np.full(terms, -1)
            rank[most_held] = np.arange(len(most_held))
            dense, common = np.zeros((len(most_held), m)), rank[term] >= 0
            dense[rank[term[common]], row[common]] = vals[common]
            order = np.flatnonzero(~common)
            order = order[np.argsort(term[order], kind="stable")]
            cold, rows, parts = term[order], row[order], vals[order]
            edge = np.searchsorted(cold, np.arange(terms + 1))
            own, over, first = np.arange(m), 1 / size, 0
        if not chain:
            while not size[first]:
                first += 1
            chain, edges = [first], []
        x = chain[-1]
        t, v = bags[x]
        near = np.zeros(m)
        at_row = rank[t]
        for r in np.flatnonzero(at_row >= 0):
            near += v[r] * dense[at_row[r]]
        start = edge[t]
        long = edge[t + 1] - start
        total = int(long.sum())
        if 3 * total < len(rows):
            at = np.arange(total) + np.repeat(start - np.cumsum(long) + long, long)
            np.add.at(near, own[rows[at]], parts[at] * np.repeat(v, long))
        else:
            whole = np.zeros(terms)
            whole[t] = v
            near += np.bincount(own[rows], parts * whole[cold], m)
        near *= over
        near[x] = 0
        most = near.max()
        if most > 0:
            best = np.flatnonzero(near >= most * (1 - 1e-9))
            s = near[best] / size[x]
            s = s * 131073 - (s * 131073 - s)  # 36 bits
            y, s = int(best[s.argmax()]), float(s.max())
        else:
            y, s = int(next(y for y in np.flatnonzero(size) if y != x)), 0.0
        found = (-s, min(x, y), max(x, y))
        if not edges or (found < edges[-1] and y not in chain):
            chain.append(y)
            edges.append(found)
            continue
        s, i, j = edges[-1]
        del chain[-2:], edges[-2:]
        merges.append((s, int(name[i]), int(name[j])))
        own[own == j] = i
        dense[:, i] += dense[:, j]
        dense[:, j] = 0
        (t, v), (less, small) = sorted((bags[i], bags[j]), key=lambda x: -len(x[0]))
        at = np.searchsorted(t, less)
        new = np.append(t, -1)[at] != less
        v[at[~new]] += small[~new]
        bags[i], bags[j] = (np.insert(t, at[new], less[new]), np.insert(v, at[new], small[new])), (t[:0], v[:0])
        size[i] += size[j]
        size[j] = 0
        over[i], over[j] = 1 / size[i], 0
        live -= 1
    label = list(range(n))
    for _, i, j in sorted(merges)[: max(0, n - k)]:
        label[j] = i
    for r in range(n):
        label[r] = label[label[r]]
    return np.unique(label, return_inverse=True)[1]


def _select(row: np.ndarray, term: np.ndarray, tf: np.ndarray, squares: np.ndarray, weight: np.ndarray, k: int) -> list[int]:
    """Places of the representatives of ``k`` clusters of weighted classes.

    The entries are those of lines that more than one class has; ``squares`` are
    of all lines of a class.
    """
    n = len(weight)
    value = tf / np.sqrt(squares[row])
    label = average_linkage(row, term, value, weight, k)
    # the sum of distances in the cluster, from the sum of its vectors
    slot = label[row] * (int(term.max(initial=0)) + 1) + term
    keys, where = np.unique(slot, return_inverse=True)
    total = np.bincount(where, value * weight[row], len(keys))
    own = squares - np.bincount(row, tf * tf, n)  # of lines that no other class has; a text without lines counts as like itself
    near = np.bincount(row, value * total[where], n) + weight * np.where(squares > 0, own / np.maximum(squares, 1), 1)
    far = np.round(np.bincount(label, weight)[label] - near, 9)
    best: dict[int, int] = {}
    for i, c in enumerate(label):
        if c not in best or far[i] > far[best[c]]:
            best[c] = i
    return sorted(best.values())


def distinct_selection(df: DataFrame, stratum: str, key: str, text: str, k: int = 50, min_chars: int = 1500) -> DataFrame:
    """``(stratum, key)``: per stratum the member of each of ``k`` clusters that is
    farthest from the rest of its cluster (the first of equals).

    All texts take part.  Texts of the same lines form a class that is clustered
    once, with its number of texts as weight.  One task holds a stratum's classes
    as numbers: which of them have each line that more than one has.
    """
    lines = F.filter(F.split(F.lower(F.col(text)), r"[\n\r]+"), lambda x: x != "")
    digests = F.array_sort(F.transform(lines, lambda x: F.unhex(F.sha2(x, 256))))
    long = df.where(F.length(text) >= min_chars).select(F.col(stratum).alias("stratum"), F.col(key).alias("key"), digests.alias("lines"))
    # a text without lines is like no other
    members = F.array_sort(F.collect_list("key"))
    classes = long.groupBy("stratum", "lines", F.when(F.size("lines") == 0, F.col("key")).alias("_alone")).agg(members.alias("members")).drop("_alone")
    # the n-th of a line's repeats adds 2n - 1 to the square
    none = F.struct(F.lit(None).cast("binary").alias("line"), F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("sum"))

    def add(a, x):
        n = F.when(a["line"] == x, a["n"] + 1).otherwise(F.lit(1).cast("bigint"))
        return F.struct(x.alias("line"), n.alias("n"), (a["sum"] + 2 * n - 1).alias("sum"))

    # of many members none but the first and the last k can be chosen
    few = F.when(F.size("members") > k + 1, F.concat(F.slice("members", 1, 1), F.slice("members", -k, k))).otherwise(F.col("members"))
    squares = F.aggregate("lines", none, add, lambda a: a["sum"])
    classes = cut(classes.select("stratum", F.monotonically_increasing_id().alias("class"), few.alias("members"), F.size("members").alias("texts"), squares.alias("squares"), "lines"))
    holders = classes.select("stratum", "class", F.explode("lines").alias("line")).groupBy("stratum", "line").agg(F.collect_list("class").alias("classes")).where(F.array_min("classes") < F.array_max("classes")).select("stratum", "classes")

    def pick(pdf: pd.DataFrame, lines: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.iloc[sorted(range(len(pdf)), key=[m[0] for m in pdf["members"]].__getitem__)]
        weight = pdf["texts"].to_numpy()
        if len(pdf) > k:
            ids = pdf["class"].to_numpy()
            by_id = np.argsort(ids)
            row = by_id[np.searchsorted(ids, np.concatenate([*lines["classes"], np.zeros(0, np.int64)]).astype(np.int64), sorter=by_id)]
            slots, tf = np.unique(np.repeat(np.arange(len(lines)), [len(x) for x in lines["classes"]]).astype(np.int64) * len(pdf) + row, return_counts=True)
            at = _select(slots % len(pdf), slots // len(pdf), tf.astype(float), pdf["squares"].to_numpy().astype(float), weight, k)
            chosen = [pdf["members"].iloc[i][0] for i in at]
        else:  # equal texts merge, class by class, until k clusters are left
            chosen, merges = [], max(0, int(weight.sum()) - k)
            for m, n in zip(pdf["members"], weight):
                gone = min(merges, n - 1)
                merges -= gone
                chosen += [m[0], *m[len(m) - (n - 1 - gone) :]]
        return pd.DataFrame({stratum: [pdf["stratum"].iloc[0]] * len(chosen), key: sorted(chosen)})

    schema = df.select(stratum, key).schema
    return classes.drop("lines").groupBy("stratum").cogroup(holders.groupBy("stratum")).applyInPandas(pick, schema)
