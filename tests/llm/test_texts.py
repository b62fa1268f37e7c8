"""What work on texts leaves behind in a worker."""

import subprocess
import sys

WORK = """
import re
from pathlib import Path

import pyarrow as pa

from barloom.llm.texts import NOT_LETTERS, Words, all_chunks, buffers
from barloom.llm.toxicity import Sentences


def held():
    return sum(map(int, re.findall(r"\\n(?:Private_Dirty|Shared_Dirty):\\s+(\\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024


def batches():
    for k in range(4):
        yield pa.RecordBatch.from_arrays([pa.array([" ".join(f"w{i * k % 9973}" for i in range(400))] * 5_000)], ["text"])


list(all_chunks([next(batches()).slice(0, 10)], "text"))
before = held()
rows = 0
for chunk in all_chunks(batches(), "text"):
    rows += len(chunk) * (Sentences(chunk.column("text")).docs > 0)
    Words(*buffers(chunk.column("text"))).shingles(5)
    del chunk
print(rows, held() - before)
"""


def test_a_worker_gives_memory_back():
    done = subprocess.run([sys.executable, "-c", WORK], capture_output=True, text=True, check=True)
    rows, mb = done.stdout.split()
    assert int(rows) == 20_000 and float(mb) < 20
