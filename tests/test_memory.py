"""Text tasks of the pipeline: what a worker holds while it runs and after it."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from wellspring.llm import ngram_join, repeats, textops, toxicity


class Task:
    """Stands for a DataFrame and keeps the function that Spark would run."""

    schema = None

    def mapInArrow(self, run, schema):
        self.run = run
        return self


def batch(mb: int = 6) -> pa.RecordBatch:
    rng = np.random.default_rng(5)
    words = np.array(["".join(rng.choice(list("abcdefghij"), rng.integers(2, 9))) for _ in range(3000)])
    texts = [" ".join(rng.choice(words, 400)) for _ in range(mb * 430)]
    return pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"])


def with_anchors(docs: pa.RecordBatch) -> pa.RecordBatch:
    return pa.record_batch([docs.column(0).cast(pa.string()).cast(pa.binary()), docs.column(1), pa.array([[]] * docs.num_rows, pa.list_(pa.int64()))], ["text_id", "text", "shared"])


TASKS = {
    "toxicity": lambda: (toxicity.drop_toxic(Task(), toxicity.FactorizationMachine()).run, batch()),
    "shingles": lambda: (ngram_join._shingles(Task(), 5).run, batch()),
    "sets": lambda: (ngram_join._sets(Task(), 5, ngram_join.Fraction("0.8")).run, batch()),
    "segments": lambda: (repeats._segments(Task(), 400).run, with_anchors(batch())),
}


@pytest.mark.parametrize("name", TASKS)
def test_text_tasks_hold_little(name, monkeypatch):
    for powers in (textops.POWERS, textops.INVERSES):  # as in a new worker
        monkeypatch.setattr(powers, "values", np.ones(1, np.uint64))
    run, docs = TASKS[name]()
    tracemalloc.start()
    try:
        for _ in run(iter([docs])):
            pass
        peak = tracemalloc.get_traced_memory()[1] / 2**20
    finally:
        tracemalloc.stop()
    assert peak < 60, f"{peak:.0f} MB"


def test_memory_is_given_back_when_the_task_holds_nothing(monkeypatch):
    events = []

    class Held:
        def __del__(self):
            events.append("freed")

    def run(batches):
        held = Held()  # noqa: F841 - lives as long as the task's frame
        yield from batches

    monkeypatch.setattr(textops, "give_back", lambda: events.append("given back"))
    assert list(textops.giving_back(run)(iter([1, 2]))) == [1, 2]
    assert events == ["freed", "given back"]


def test_powers_do_not_depend_on_how_they_grew():
    grown, at_once = textops._Powers(textops.BASE), textops._Powers(textops.BASE)
    for n in (1, 70_000, 10, 200_000):
        assert len(grown.upto(n)) == n
    assert (grown.upto(200_000) == at_once.upto(200_000)).all()
    assert len(grown.values) < 200_000 + (1 << 16)
