"""Python workers give back the memory of their tasks."""

from __future__ import annotations

import re
from pathlib import Path

import pyarrow as pa

from ledgerloom.llm import common


def held() -> int:
    """MB of this process."""
    return int(re.search(r"Anonymous:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) // 1024


def test_freed_memory_goes_back_to_the_system():
    pieces = [bytes(1024) for _ in range(150_000)]
    pieces, full = pieces[-1:], held()  # the last piece keeps the heap from shrinking by itself
    common.give_back()
    assert full - held() > 100 and len(pieces) == 1


def test_a_task_gives_back_at_its_end(monkeypatch):
    calls, batch = [], pa.record_batch([pa.array([1, 2])], names=["x"])
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    run = common.gives_back(lambda batches: (b.slice(1) for b in batches))
    out = run(iter([batch, batch]))
    assert next(out).num_rows == 1 and not calls
    assert [b.column("x").to_pylist() for b in out] == [[2]] and calls == [1]


def test_workers_of_the_line_and_near_duplicate_operators_give_back():
    """Every function over batches of these operators is wrapped."""
    for name in ("line_dedup", "chosen_path", "quality_fm"):
        source = Path(common.__file__).with_name(f"{name}.py").read_text()
        used = re.findall(r"\.mapInArrow\((\w+)", source)
        assert used and set(used) == {"gives_back"}
