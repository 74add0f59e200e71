"""The driver's contract: queries agree with their SQL, and nothing else needs the optional parts."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from tallyfield.plans import registry

duckdb = pytest.importorskip("duckdb")

DATA, REPO = Path("/root/testdata/sf0.001"), Path(__file__).resolve().parent.parent
TABLES = "region nation customer supplier part orders lineitem".split()
SAMPLE = ["location_dim", "month_obs", "year_obs", "region_month_obs", "cell_refs", "grid_rollup", "orphan_cells_anti", "loc_meta", "loc_qcount", "zone_species", "loc_cell_ref_left", "lifers", "finest_regions_anti", "month_pivot", "cells_full_outer", "csr_offsets", "release_calendar", "search_prefix", "kcenter", "pack_json", "pack_binary", "blob_cache", "hex_cells", "hex_parents", "area_species", "search_blocks", "places_in_boxes", "nearest_hotspots", "best_of_each_species", "ranked_table"]


@pytest.fixture(scope="module")
def other():
    if not DATA.exists():
        pytest.skip("the driver's tables aren't here")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, other, name):
    got, want = registry.queries()[name](spark, str(DATA)).toPandas(), other.execute(registry.oracle_sql()[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    text = [x[cols].astype(str).sort_values(cols).values.tolist() for x in (got, want)]
    assert text[0] == text[1]


def test_every_query_has_sql_or_is_listed():
    assert set(registry.queries()) - set(registry.oracle_sql()) == set()


@pytest.mark.parametrize("pipeline", [True, False])
def test_without_the_optional_parts(tmp_path, pipeline):
    """Both optional folders gone, the pipeline's file left or gone: the entry lists the rest, every other test can be collected, and those of functions pass."""
    shutil.copytree(REPO / "tallyfield", tmp_path / "tallyfield", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copytree(REPO / "tests", tmp_path / "tests", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "bench.py", *(["corpus_pipeline.py"] if pipeline else [])):
        shutil.copy(REPO / name, tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'year_obs' in q and 'pipeline' not in q and not any(n.startswith('op') and n[2].isdigit() for n in q); e.oracle_sql()"
    old = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and Path(p).resolve() != REPO]
    env = os.environ | {"PYTHONPATH": os.pathsep.join([str(tmp_path), *old])}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=env)
    if pipeline:
        subprocess.run([sys.executable, "-m", "pytest", "-q", "--collect-only", "tests"], cwd=tmp_path, check=True, env=env)
        subprocess.run([sys.executable, "-m", "pytest", "-q", "-x", "tests/test_functions.py"], cwd=tmp_path, check=True, env=env)


def test_year_obs_is_computed_once(spark):
    """What lies behind the scores of locations is stored before it is read again."""
    t = registry.Tables(spark, str(DATA))
    assert not any("lineitem" in f for f in t.loc_species.inputFiles()) and {"dim", "samples", "year_obs"} <= t.stored


@pytest.mark.parametrize("name", ["orphan_cells_anti", "grid_stats", "region_chart"])
def test_checklists_are_not_read_again(spark, name):
    """The dimension and the samples are stored: what is left reads orders for the observations alone."""
    df = registry.queries()[name](spark, str(DATA))
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet [o_orderkey") == 1


def test_few_codes_are_broadcast(spark):
    plan = registry.queries()["species_name_lookup"](spark, str(DATA))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(species_id" not in plan
