import os
import tempfile

from strata.sources.seeds import packaged_seed_rows, parse_seed_csv, read_seed_csv


def test_seed_csv_round_trip(spark):
    rows = packaged_seed_rows()
    assert ("Children's", "Children") in rows and ("(no genres listed)", "Unknown") in rows
    text = "raw_genre,display_genre\n" + "\n".join(
        ",".join('"' + v.replace('"', '""') + '"' if ("," in v or "'" in v) else v for v in r)
        for r in rows
    )
    assert parse_seed_csv(text) == rows
    d = tempfile.mkdtemp(prefix="strata-seed-")
    path = os.path.join(d, "genre_mapping.csv")
    with open(path, "w") as f:
        f.write(text + "\n")
    got = [tuple(r) for r in read_seed_csv(spark, path).collect()]
    assert got == rows
    assert len(got) == 21
