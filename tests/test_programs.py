"""The verification and geocoding programs, one after the other, over files."""

from __future__ import annotations

import json

import tabularium.geocode_cli
import tabularium.verify_cli
from tabularium.sources import files


def test_verify_then_geocode(spark, tmp_path, monkeypatch):
    # Functions of a function go to the workers as they are; a test module can't be imported there.
    def verifier(row: dict) -> dict:
        inputs = json.loads(row["prompt"].split("\n", 1)[1])
        found = [{"index": int(i["index"]), "confidence": "high", "matchedAddress": i["address"] + ", Town"} for i in inputs if i.get("name") != "Nobody"]
        return {"text": json.dumps({"results": found}), "input_tokens": 100, "output_tokens": 10}

    def place(address: str) -> dict:
        return {"status": "OK", "formatted_address": address.upper(), "lat": 1.5, "lng": -2.0} if "Town" in address else {"status": "ZERO_RESULTS"}

    for module in (tabularium.verify_cli, tabularium.geocode_cli):
        monkeypatch.setattr(module, "build_session", lambda: spark)
        monkeypatch.setattr(module, "client_of", {"verifier": verifier, "place": place}.get)
    given = tmp_path / "in"
    given.mkdir()
    people = [{"name": "A", "address": "1 Road"}, {"name": "Nobody", "fullAddress": " 2 Road "}, {"name": "C"}, {"title": "D", "address": "1 Road"}]
    (given / "one.json").write_text(json.dumps({"records": people}))
    (given / "two.json").write_text(json.dumps(people[:1]))
    (given / "none.json").write_text("[]")
    verified, located = str(tmp_path / "verified"), str(tmp_path / "located")
    tabularium.verify_cli.main([str(given), verified, "--client", "verifier", "--batch-size", "2", "--model", "m"])
    rows = files.verified_records(spark, f"{verified}/records").collect()
    got = {(r.file, r.ord): (r.verification.confidence, r.verification.matched_address) for r in rows}
    assert got == {
        ("one.json", 0): ("high", "1 Road, Town"), ("one.json", 1): ("unknown", None), ("one.json", 2): ("unknown", None), ("one.json", 3): ("high", "1 Road, Town"), ("two.json", 0): ("high", "1 Road, Town"),
    }
    costs = spark.read.json(f"{verified}/costs").first()
    assert (costs.calls, costs.input_tokens, costs.model) == (3, 300, "m")
    tabularium.geocode_cli.main([f"{verified}/records", located, "--verified", "--client", "place"])
    counts = spark.read.json(f"{located}/counts").first()
    assert (counts.total, counts.located, counts.unique_queries, counts.skipped) == (5, 3, 2, 1)
    features = [json.loads(r.value) for r in spark.read.text(f"{located}/features").collect()]
    assert [f["geometry"]["coordinates"] for f in features] == [[-2.0, 1.5]] * 3 and {f["properties"]["formattedAddress"] for f in features} == {"1 ROAD, TOWN"}
    # Without verification the record's own address is looked up; a second run writes over the first.
    tabularium.geocode_cli.main([str(given), located, "--client", "place", "--no-geojson"])
    assert spark.read.json(f"{located}/counts").first().located == 0
