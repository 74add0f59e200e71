"""The command line, from raw extracts to packs."""

import json

from tallyfield.__main__ import main
from tallyfield.sources import readers, schema

from .test_plans import many


def tsv(path, rows, names, tail):
    head = [*names, *tail]
    text = lambda v: "" if v is None else str(v)
    path.write_text("\n".join(["\t".join(head), *["\t".join([*map(text, r), *tail.values()]) for r in rows]]) + "\n")


def test_all_steps(spark, tmp_path):
    checklists, observations = many()
    order = list(schema.CHECKLIST_COLUMNS.values())
    kinds = [f.name for f in schema.CHECKLISTS]
    tsv(tmp_path / "c.tsv", [[r[kinds.index(c)] for c in order] for r in checklists], schema.CHECKLIST_COLUMNS, {schema.COMPLETE: "1"})
    names = [f.name for f in schema.OBSERVATIONS]
    tsv(tmp_path / "o.tsv", [[r[names.index(c)] for c in schema.OBSERVATION_COLUMNS.values()] for r in observations], schema.OBSERVATION_COLUMNS, {schema.COMPLETE: "1", schema.CATEGORY: "species"})
    (tmp_path / "t.json").write_text(json.dumps([{"sciName": "robin", "comName": "Robin", "speciesCode": "rob", "taxonOrder": 1.0}]))
    run = lambda *a: main(["--env", str(tmp_path / "none"), *map(str, a)], spark)
    run("extract-observations", tmp_path / "o.tsv", tmp_path / "o")
    run("extract-checklists", tmp_path / "c.tsv", tmp_path / "c")
    inputs = [tmp_path / "o", tmp_path / "c", tmp_path / "t.json"]
    run("targets", *inputs, "--output", tmp_path / "db", "--version-year", "2024", "--version-month", "May")
    run("grid", *inputs, "--output", tmp_path / "db", "--version", "may-2024", "--resolutions", 6, 4)
    run("occurrences", tmp_path / "db", tmp_path / "occ", "--zone-res", 3, "--version-year", "2024", "--version-month", "May")
    assert readers.read_table(spark, str(tmp_path / "occ"), "loc_meta").first()["location_id"] == "Z"
    (tmp_path / "p.json").write_text(json.dumps([{"id": 1, "region": "US-CA", "name": "California"}]))
    (tmp_path / "h.json").write_text(json.dumps([{"locId": "Z", "locName": "Zed", "lat": 10.2, "lng": 20.2, "countryCode": "US", "subnational1Code": "US-CA"}]))
    (tmp_path / "n.json").write_text(json.dumps({"US": "United States", "US-CA": "California"}))
    run("packs", tmp_path / "db", tmp_path / "packs", tmp_path / "p.json", tmp_path / "h.json", tmp_path / "n.json", "--version", "may-2024", "--res", 6, "--regions", "us-ca")
    doc = json.loads(spark.read.text(str(tmp_path / "packs/may-2024")).first().value)
    assert doc["hotspots"][0]["stateName"] == "California" and {t["id"] for t in doc["targets"]} >= {"Z"}
