"""What a Python worker holds while a task runs and keeps after it."""

import os

import pyarrow as pa

from lorebase.llm import common, secrets


class Frame:
    """A table that hands out the function it is mapped with."""

    columns, schema = ["text"], None

    def mapInArrow(self, job, schema):
        return job


def resident():
    with open("/proc/self/statm") as file:
        return int(file.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")


def test_a_task_gives_its_memory_back():
    later = []

    def step(batches):
        for batch in batches:
            held = [b"%2000d" % number for number in range(100_000)]
            # Something that outlives the task stands behind what it held.
            later.append(held.pop())
            yield batch

    job = common.map_batches(Frame(), "text STRING", step)
    before = resident()
    assert len(list(job(iter([pa.record_batch({"text": ["a"]})])))) == 1
    assert resident() - before < 50e6 and len(later) == 1


def test_large_batches_are_worked_on_in_runs():
    text = "password = abcdefgh1234 " + "word " * 120_000
    batch = pa.record_batch({"text": [text, text, None, text, ""]})
    found = list(secrets.redacted(Frame())(iter([batch])))
    assert max(part.nbytes for part in found) < 1.5e6
    hidden = text.replace("abcdefgh1234", "[SECRET]")
    assert [value for part in found for value in part.column(0).to_pylist()] == [hidden, hidden, None, hidden, ""]
