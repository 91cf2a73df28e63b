"""What Python workers hold."""

import tracemalloc

import pyarrow as pa

from harvestline.llm import collocations, common


def resident():
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * 4096


def test_freed_memory_goes_back_to_the_system():
    blocks = [bytearray(4096) for _ in range(50_000)]
    last = blocks[-1]  # the end of the heap stays in use
    del blocks
    held = resident()
    common.give_back()
    assert held - resident() > 100 << 20 and last is not None


def test_a_task_gives_back_what_it_has_freed(spark):
    def rows(batches):
        blocks = [bytearray(4096) for _ in range(50_000)]
        common.KEPT = blocks[-1]
        del blocks
        yield from batches

    def measure(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([resident()] * len(batch))], ["held"])

    one = spark.range(1).coalesce(1)
    common.map_arrow(one, rows, one.schema).collect()
    assert one.mapInArrow(measure, "held long").first().held < 250 << 20


def test_words_of_a_long_text_take_little_memory(monkeypatch):
    monkeypatch.setattr(collocations, "_POWERS", {})
    texts = pa.array(["some words of a text, " * 200_000])
    tracemalloc.start()
    try:
        assert sum(len(w.row) for w in collocations.words_of(texts)) == 1_000_000
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 96 << 20
