"""Python workers give back what a stage has left before the next stage uses them."""

import numpy as np
import pyarrow as pa
import pytest

from ledgerlark.llm import common, line_dedup, near_dups, packing


def resident_mb():
    with open("/proc/self/status") as f:
        return next(int(line.split()[1]) for line in f if line.startswith("VmRSS")) / 1024


def test_memory_is_given_back_at_the_end_also_of_a_failed_task(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    assert list(common.freeing(lambda batches: (b + 1 for b in batches))(iter([1, 2]))) == [2, 3] and calls == [1]

    def failing(batches):
        yield next(batches)
        raise ValueError("bad batch")

    with pytest.raises(ValueError, match="bad batch"):
        list(common.freeing(failing)(iter([1])))
    assert calls == [1, 1]


def test_freed_memory_leaves_the_process():
    def hold(batches):
        kept = [np.ones(2000) for _ in range(20_000)]  # 320 MB in pieces that the C library keeps
        last = np.ones(2000)  # lies above them
        del kept
        yield resident_mb()
        del last

    before = resident_mb()
    (inside,) = common.freeing(hold)(iter([]))
    assert resident_mb() < before + 100, inside


def test_packing_gives_back_before_it_loads_its_vocabulary(monkeypatch):
    order, load = [], packing._tokens
    monkeypatch.setattr(packing, "give_back", lambda: order.append("give back"))
    monkeypatch.setattr(packing, "_tokens", lambda path: order.append("load") or load(path))
    rb = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["two words"])], names=["doc_id", "text"])
    assert len(list(packing._cut_pieces(iter([rb]), None, 2048, False))) == 1 and order == ["give back", "load"]


def test_stages_of_the_pipeline_are_wrapped():
    for module in (line_dedup, near_dups, packing):
        assert module.freeing is common.freeing
