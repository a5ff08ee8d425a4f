"""What an analysis leaves on disk: reports, tables and sequences, by group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basewise.operators import report, tree
from basewise.operators.coverage import double_normalised
from basewise.plans.caller import Caller
from basewise.sources.sinks import write_table


def flat(df: DataFrame) -> DataFrame:
    """df with nested columns as JSON, as text files have none."""
    nested = [f.name for f in df.schema.fields if f.dataType.typeName() in ("array", "map", "struct")]
    return df.withColumns({c: F.to_json(c) for c in nested}) if nested else df


def write_text_table(df: DataFrame, path: str, sep: str = "\t") -> None:
    """A header and a folder a group; rewritten as a whole."""
    writer = flat(df).write.mode("overwrite")
    (writer.partitionBy("group_id") if "group_id" in df.columns else writer).csv(path, sep=sep, header=True)


def write_call(caller: Caller, path: str, names: list[str]) -> None:
    """Every output of the caller below path; names are the samples'.

    filters, merged (draft, final, label0), mutations, predictions (fast mode)
    and dnds as tab-separated text; snvs_per_sample, recombination, distances
    and snp_chart as comma-separated; final as Parquet; sequences as FASTA.
    """
    merged = report.split_by_label(caller.merged)
    tabbed = {"filters": caller.filters, "mutations": caller.mutation_table(names), "predictions": caller.predictions(names), "dnds": caller.dnds} | {f"merged_{k}": df for k, df in merged.items()}
    for name, df in tabbed.items():
        write_text_table(df, f"{path}/{name}")
    chart = tree.snp_chart(caller.named_tree_cells, "tree_call", caller.contigs, names)
    commas = {"snvs_per_sample": caller.snvs_per_sample, "recombination": caller.recombination, "distances": caller.distances, "snp_chart": chart}
    for name, df in commas.items():
        write_text_table(df, f"{path}/{name}", ",")
    write_table(caller.final, f"{path}/final")
    tree.fasta(caller.alignment).write.mode("overwrite").partitionBy("group_id").text(f"{path}/sequences")


def write_coverage(coverage: DataFrame, path: str) -> None:
    """Raw coverage, and as spreads over samples and positions in thousandths."""
    write_table(coverage, f"{path}/raw")
    write_table(double_normalised(coverage), f"{path}/normalised")
