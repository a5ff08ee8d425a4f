"""Distances between samples, neighbour joining, parsimony on a given tree."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basewise.functions.bases import int_to_nt
from basewise.operators.coverage import with_contig
from basewise.operators.masks import SITE
from basewise.operators.report import calls_pivot


def pairwise_distance(cells: DataFrame, call: str) -> DataFrame:
    """sample_a < sample_b, compared, different: positions that both call.

    A sample's calls of 64 positions are packed into a word a letter, and pairs
    of samples meet a word at a time: a join row stands for 64 positions.
    """
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("p", F.lit(64)).cast("int"))
    packed = [F.bit_or(F.when(F.col(call) == i, bit).otherwise(F.lit(0).cast("long"))) for i in (1, 2, 3, 4)]
    held = cells.where(F.col(call) > 0).groupBy("group_id", F.floor(F.col("p") / 64).alias("block"), "sample_id").agg(*(x.alias(f"w{i}") for i, x in enumerate(packed, 1)))
    a = held.withColumnRenamed("sample_id", "sample_a")
    b = held.select("group_id", "block", F.col("sample_id").alias("sample_b"), *(F.col(f"w{i}").alias(f"v{i}") for i in (1, 2, 3, 4)))
    every = lambda c: F.col(f"{c}1").bitwiseOR(F.col(f"{c}2")).bitwiseOR(F.col(f"{c}3")).bitwiseOR(F.col(f"{c}4"))
    same = sum((F.bit_count(F.col(f"w{i}").bitwiseAND(F.col(f"v{i}"))) for i in (2, 3, 4)), F.bit_count(F.col("w1").bitwiseAND(F.col("v1"))))
    pairs = a.join(b, ["group_id", "block"]).where("sample_a < sample_b").select("group_id", "sample_a", "sample_b", F.bit_count(every("w").bitwiseAND(every("v"))).cast("long").alias("n"), same.cast("long").alias("same"))
    return pairs.groupBy("group_id", "sample_a", "sample_b").agg(F.sum("n").alias("compared"), F.sum(F.col("n") - F.col("same")).alias("different")).where("compared > 0")


def alignment(cells: DataFrame, call: str, samples: DataFrame, anc: DataFrame) -> DataFrame:
    """name, sequence: the ancestor and every sample, positions in order."""
    rows = cells.join(F.broadcast(samples.select("group_id", "sample_id", "sample_name")), ["group_id", "sample_id"]).select("group_id", F.col("sample_name").alias("name"), "p", int_to_nt(F.col(call)).alias("nt"))
    first = anc.join(cells.select(*SITE).distinct(), SITE, "left_semi").select("group_id", F.lit("inferred_ancestor").alias("name"), "p", int_to_nt(F.col("anc")).alias("nt"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("p", "nt"))), lambda x: x["nt"]), "")
    return rows.unionByName(first).groupBy("group_id", "name").agg(joined.alias("sequence"))


def fasta(aligned: DataFrame) -> DataFrame:
    return aligned.select("group_id", F.concat(F.lit(">"), "name", F.lit("\n"), "sequence").alias("value"))


def neighbour_joining(names: list[str], distance: np.ndarray) -> list[tuple[str, str, float]]:
    """Edges (parent, child, length) of the tree; new nodes are n1, n2, ...

    One group's isolates, some hundreds: the matrix is the driver's.
    """
    d, held, edges, made = distance.astype(float).copy(), list(names), [], 0
    while len(held) > 2:
        n = len(held)
        total = d.sum(1)
        q = (n - 2) * d - total[:, None] - total[None, :]
        np.fill_diagonal(q, np.inf)
        i, j = np.unravel_index(int(q.argmin()), q.shape)
        made += 1
        name = f"n{made}"
        left = d[i, j] / 2 + (total[i] - total[j]) / (2 * (n - 2))
        edges += [(name, held[i], float(left)), (name, held[j], float(d[i, j] - left))]
        new = (d[i] + d[j] - d[i, j]) / 2
        keep = [k for k in range(n) if k not in (i, j)]
        d = np.block([[d[np.ix_(keep, keep)], new[keep][:, None]], [new[keep][None, :], np.zeros((1, 1))]])
        held = [held[k] for k in keep] + [name]
    if len(held) == 2:
        edges.append((held[1], held[0], float(d[0, 1])))
    return edges


def nj_tree(distances: DataFrame, group_id: int = 1) -> DataFrame:
    """parent, child, length from pairwise_distance's rows of one group."""
    spark = distances.sparkSession
    rows = distances.where(F.col("group_id") == group_id).select("sample_a", "sample_b", F.coalesce(F.try_divide(F.col("different").cast("double"), F.col("compared").cast("double")), F.lit(0.0)).alias("d")).toPandas()
    names = sorted({*rows.sample_a, *rows.sample_b})
    at = {n: i for i, n in enumerate(names)}
    d = np.zeros((len(names), len(names)))
    for a, b, x in rows.itertuples(index=False):
        d[at[a], at[b]] = d[at[b], at[a]] = x
    return spark.createDataFrame(neighbour_joining([str(n) for n in names], d), "parent string, child string, length double")


def newick(edges: list[tuple[str, str, float]]) -> str:
    kids: dict[str, list[tuple[str, float]]] = {}
    for parent, child, length in edges:
        kids.setdefault(parent, []).append((child, length))
    root = ({p for p, _, _ in edges} - {c for _, c, _ in edges}).pop()

    def told(node: str) -> str:
        if node not in kids:
            return node
        return "(" + ",".join(f"{told(c)}:{x:.6f}" for c, x in kids[node]) + ")" + (node if not node.startswith("n") else "")

    return told(root) + ";"


def fitch(edges: list[tuple[str, str, float]], letters: dict[str, str]) -> int:
    """The least number of changes of one position on a given tree.

    Tips that aren't in letters, or hold N, fit anything.
    """
    kids: dict[str, list[str]] = {}
    for parent, child, _ in edges:
        kids.setdefault(parent, []).append(child)
    root = ({p for p, _, _ in edges} - {c for _, c, _ in edges}).pop()
    changes = 0

    def sets(node: str) -> set[str]:
        nonlocal changes
        held = {letters[node]} if letters.get(node, "N") != "N" else None
        for one in (sets(k) for k in kids.get(node, [])):
            if held is None or held & one:
                held = one if held is None else held & one
            else:
                held, changes = held | one, changes + 1
        return held or set("ATCG")

    sets(root)
    return changes


def tip_changes(cells: DataFrame, call: str) -> DataFrame:
    """Per position: the commonest letter (the greater on ties) and how many
    samples hold another."""
    votes = cells.where(F.col(call) > 0).groupBy(*SITE, int_to_nt(F.col(call)).alias("nt")).agg(F.count(F.lit(1)).alias("n"))
    return votes.groupBy(*SITE).agg(F.max(F.struct("n", "nt"))["nt"].alias("anc_nt"), (F.sum("n") - F.max("n")).alias("n_changes"))


#: The colours of letters in a tree viewer's notation.
COLOURS = {"A": "-16776961", "C": "-16725916", "G": "-3670016", "T": "-3618816"}
OTHER_COLOUR = "-16777216"


def nexus(newick_text: str, letters: dict[str, str]) -> str:
    """One position on a tree: tips are named with their letter and coloured.

    Tips without a letter hold a question mark.
    """
    tips = re.findall(r"(?<=[(,])[^(),:;]+", newick_text)
    named = {tip: f"{tip}--*{letters.get(tip, '?')}" for tip in tips}
    lines = [f"\t'{named[tip]}'[&!color=#{COLOURS.get(letters.get(tip, '?'), OTHER_COLOUR)}]" for tip in tips]
    tree = re.sub(r"(?<=[(,])[^(),:;]+", lambda m: f"'{named[m[0]]}'", newick_text)
    return "\n".join(["#NEXUS", "begin taxa;", f"\tdimensions ntax={len(tips)};", "\ttaxlabels", *lines, ";", "end;", "", "begin trees;", f"\ttree tree_1 = [&R] {tree}", "end;", ""])


def snp_chart(cells: DataFrame, call: str, contigs: DataFrame, names: list[str]) -> DataFrame:
    """chr, pos and a letter a sample: what single-position trees are made from."""
    letters = with_contig(calls_pivot(cells, call, names), contigs)
    return letters.select("group_id", F.col("contig_idx").alias("chr"), F.col("contig_pos").alias("pos"), *names)
