"""Held-out accuracy of the trained operators on the driver's documents."""

from __future__ import annotations

from starloom.llm.common import read
from starloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_language_on_the_held_out_fold(spark):
    out = QUERIES["op2_language_id"](spark, SF).join(read(spark, SF, "documents", "doc_id", "lang"), "doc_id")
    held = [r for r in out.collect() if r["held_out"] and r["lang"]]
    assert len(held) > 300
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)


def test_toxicity_on_the_held_out_fold(spark):
    out = QUERIES["op3_toxicity"](spark, SF).join(read(spark, SF, "labels", "doc_id", "toxic"), "doc_id")
    held = [r for r in out.collect() if r["held_out"]]
    hit = [r["toxic"] for r in held if r["predicted"]]
    assert len(held) > 100 and sum(hit) >= 0.95 * len(hit)  # clean documents are left alone
    toxic = [r["predicted"] for r in held if r["toxic"]]
    assert sum(toxic) >= 0.75 * len(toxic)
    assert all((r["score"] >= 0.7) == bool(r["predicted"]) for r in held)


def test_equal_runs_give_equal_scores(spark):
    one, two = (sorted(map(tuple, QUERIES["op3_toxicity"](spark, SF).collect())) for _ in range(2))
    assert one == two
