"""A catalog read once: rows, lines that don't fit with their reasons, and counts."""

import json
import shutil

from weir.sources import records

GOOD = [{"id": "1", "title": "a"}, {"id": "2", "title": "", "year": 2020, "tags": ["x"], "unknown": 1}, {"id": "3", "title": "c", "license": {"spdx_id": "MIT"}}, {"id": "1", "title": "again"}]
BAD = {
    '{"id": "4", "title": ': "malformed", "no json": "malformed", '["id"]': "malformed", '"text"': "malformed", "7": "malformed", "null": "malformed", '{"id": "5", "title": "t", "year": "soon"}': "malformed",
    '{"id": "6", "title": "t", "tags": "x"}': "malformed", "{}": "no id", '{"id": "", "title": "t"}': "no id", '{"id": null, "title": "t"}': "no id", '{"id": "8"}': "no title", '{"id": "9", "title": null}': "no title",
}


def test_rows_lines_and_counts_of_one_pass(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [*map(json.dumps, GOOD), *BAD, "", "  ", "\t"]
    for k in range(3):
        (tmp_path / f"in/{k}.jsonl").write_text("\n".join(lines[k::3]) + "\n")
    done = records.read_checked(spark, str(tmp_path / "in"))
    shutil.rmtree(tmp_path / "in")  # nothing is read again
    assert sorted((r["id"], r["title"], r["year"]) for r in done.rows.collect()) == sorted((x["id"], x["title"], x.get("year")) for x in GOOD)
    assert done.rows.schema == records.schema.CHALLENGE or [f.name for f in done.rows.schema] == records.schema.CHALLENGE.names
    found = {r["line"]: (r["reason"], r["file"].rsplit("/", 1)[-1]) for r in done.quarantine.collect()}
    assert {k: r for k, (r, _) in found.items()} == BAD and {f for _, f in found.values()} == {"0.jsonl", "1.jsonl", "2.jsonl"}
    assert done.counts == {"lines": len(GOOD) + len(BAD), "rows": len(GOOD), "malformed": 8, "no id": 3, "no title": 2}


def test_all_good_all_bad_and_none(spark, tmp_path):
    for name, body, counts in (("good", '{"id": "1", "title": "a"}\n', (1, 1, 0)), ("bad", "x\n", (1, 0, 1)), ("none", "\n", (0, 0, 0))):
        (tmp_path / name).write_text(body)
        done = records.read_checked(spark, str(tmp_path / name))
        assert (done.counts["lines"], done.counts["rows"], done.counts["malformed"]) == counts
        assert (done.rows.count(), done.quarantine.count()) == counts[1:]
