"""A few registered queries against their SQL, and the entry."""

import os

import pandas as pd
import pytest

import __spark_entry__
from basewise.plans import queries

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SMALL = ["cmt_cells", "cell_attributes", "mask_copy_number", "filter_tokens", "mutation_quality", "gene_neighbours", "codon_effects", "cnn_tensor", "histogram_snv", "histogram_frac_n", "mask_samples", "ambiguity_fraction_strict", "sample_renamed"]
#: Whose masks leave calls only where cells have more reads.
CALLED = ["pairwise_distance", "filter_table", "scorable_positions", "mutation_table", "fast_predictions", "reanalysed_extras", "gap_statistics", "dnds_ratio", "recomb_pairs", "mutation_strings"]
#: Which have rows where no cell has enough reads for a call, so that there is no mutation.
UNMUTATED = ["mutation_spectrum", "dnds_expected", "dnds_observed", "dnds_ratio"]
duckdb = pytest.importorskip("duckdb")


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name,sf", [(n, SF) for n in SMALL] + [(n, LARGER) for n in CALLED])
def test_query_equals_its_sql(spark, name, sf):
    base = duckdb.connect()
    base.execute(f"create view lineitem as select * from '{sf}/lineitem.parquet'")
    want = base.execute(queries.ORACLES[name]).df()
    got = queries.QUERIES[name](spark, sf).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    def one(x):
        if x is None or x is pd.NA or (isinstance(x, float) and x != x):
            return None
        return x if isinstance(x, str) else round(float(x), 9)

    told = lambda df: sorted(repr([one(x) for x in r]) for r in df[sorted(df.columns)].itertuples(index=False))
    assert told(got) == told(want)
    spark.catalog.clearCache()


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", UNMUTATED)
def test_query_of_no_mutation_equals_its_sql(spark, name):
    assert queries.QUERIES["mutation_type"](spark, SF).count() == 0
    test_query_equals_its_sql(spark, name, SF)
    assert queries.QUERIES[name](spark, SF).count() > 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
