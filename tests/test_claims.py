"""Two queries on one topic-partition: the stale one fails, and each record is there once."""

import pytest
from test_ingest import config, expect, log, offsets

from harborlog.sinks.claims import Claims, Fenced
from harborlog.streaming import ingest_batch
from workload.fixtures import message


def test_the_newest_claim_owns(tmp_path):
    root, both = str(tmp_path / "claims"), [("t", 0), ("t.u", 1)]
    old, new = Claims(root, "old"), Claims(root, "new")
    old.take(both)
    old.take(both)
    old.check(both)
    new.take([("t", 0)])
    new.check([("t", 0)])
    old.check([("t.u", 1)])
    for act in (old.check, old.take, Claims(root, "old").take):
        with pytest.raises(Fenced):
            act(both)
    with pytest.raises(Fenced):
        new.check([("t.u", 1)])
    old.take([]), old.check([])


@pytest.mark.parametrize("way", ["staged", "direct"])
def test_a_stale_query_fails_and_nothing_is_twice(spark, tmp_path, way):
    conf = config(tmp_path, publish=way)
    ingest_batch(log(spark, {0: (0, 10), 1: (0, 5)}), 0, conf, message(), query_id="old")

    def taken_over(step):
        if step == "recorded":
            ingest_batch(log(spark, {0: (0, 25)}), 0, conf, message(), query_id="new")

    with pytest.raises(Fenced):
        ingest_batch(log(spark, {0: (10, 20)}), 1, conf, message(), on_step=taken_over, query_id="old")
    with pytest.raises(Fenced):
        ingest_batch(log(spark, {0: (10, 30)}), 1, conf, message(), query_id="old")
    # What nobody has taken over goes on.
    ingest_batch(log(spark, {1: (5, 9)}), 2, conf, message(), query_id="old")
    ingest_batch(log(spark, {0: (20, 30)}), 1, conf, message(), query_id="new")
    assert offsets(spark, conf) == expect({0: (0, 30), 1: (0, 9)})


def test_a_batch_whose_records_were_published_meanwhile_fails(spark, tmp_path, monkeypatch):
    conf = config(tmp_path)
    ingest_batch(log(spark, {0: (0, 10)}), 0, conf, message(), query_id="old")
    take = Claims.take

    def late(self, wanted):
        # The old query has looked at its claims already and commits while the new one is at work.
        if self.owner.endswith("new"):
            monkeypatch.setattr(Claims, "take", take)
            ingest_batch(log(spark, {0: (10, 20)}), 1, conf, message(), query_id="old")
        take(self, wanted)

    monkeypatch.setattr(Claims, "take", late)
    with pytest.raises(Fenced):
        ingest_batch(log(spark, {0: (0, 30)}), 0, conf, message(), query_id="new")
    ingest_batch(log(spark, {0: (0, 30)}), 0, conf, message(), query_id="new")
    assert offsets(spark, conf) == expect({0: (0, 30)})
