import json
import os
import tempfile

from strata.__main__ import main
from strata.sources import testdata
from tests.conftest import SF001


def test_cli_build_keys_enrich(spark, capsys):
    base = tempfile.mkdtemp(prefix="strata-cli-")
    raw, store = os.path.join(base, "raw"), os.path.join(base, "tables")
    src = testdata.sources(spark, SF001)
    for name in ("raw_movies", "raw_ratings", "raw_tags", "raw_genome_tags", "raw_genome_scores", "raw_links"):
        getattr(src, name).write.parquet(os.path.join(raw, name))
    assert main(["--store", store, "build", "--raw", raw, "--as-of", "2024-02-01T00:00:00",
                 "--on-duplicate", "latest", "--order-col", "event_id", "--warn-only"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["versions"]["fct_ratings"] == 1 and len(out["checks"]) == 89

    assert main(["--store", store, "keys", "--batch-size", "5"]) == 0
    ids = [int(x) for x in capsys.readouterr().out.split()]
    assert len(ids) == 5 and ids == sorted(ids)

    resp = os.path.join(base, "responses")
    testdata.raw_responses(spark, SF001).withColumnRenamed("event_id", "request_id").write.parquet(resp)
    assert main(["--store", store, "enrich", "--responses", resp, "--as-of", "2024-02-01T06:00:00"]) == 0
    rep = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert rep["keys_queried"] == 1000 and rep["movies_loaded"] + rep["without_id"] == rep["movies_fetched"] > rep["without_id"] > 0
