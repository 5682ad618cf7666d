import ctypes
import re
import subprocess
import sys
from pathlib import Path

import pytest

import public_tokenizers
from ticklake.llm import bpe, common, minhash, pii, toxicity

#: A worker of its own: what one task leaves behind.
LEFT = """
import re, sys
import pyarrow as pa
from ticklake.llm.common import handing_back

def task(batches):
    for n in batches:
        held, pins = [bytes(4000) for _ in range(n)], []
        for x in held[::50]:
            pins.append(bytes(600))
        yield pa.array(held).nbytes

def anonymous():
    return int(re.search(r"Anonymous: +(\\d+)", open("/proc/self/smaps_rollup").read()).group(1)) / 1024

before = anonymous()
run = handing_back(task) if sys.argv[1] == "back" else task
assert all(x > 0 for x in run(iter([20_000] * 3)))
print(anonymous() - before)
"""


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists() or not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="Linux with glibc")
def test_a_task_leaves_little_memory_behind():
    top = str(Path(common.__file__).parents[2])
    left = {how: float(subprocess.run([sys.executable, "-c", LEFT, how], cwd=top, capture_output=True, text=True, check=True).stdout) for how in ("plain", "back")}
    assert left["back"] < 30 and left["back"] < left["plain"]


def test_results_pass_and_other_operators_things_go():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    bpe.bpe_of.cache_clear()
    kept = bpe.bpe_of(ranks, public_tokenizers.PATTERN)

    def task(batches):
        yield from batches

    task.__module__ = bpe.__name__
    assert list(common.handing_back(task)(iter([1, 2]))) == [1, 2]
    assert bpe.bpe_of(ranks, public_tokenizers.PATTERN) is kept  # for its next task
    task.__module__ = toxicity.__name__
    assert list(common.handing_back(task)(iter([]))) == []
    assert bpe.bpe_of.cache_info().currsize == 0


def test_every_task_of_the_pipeline_hands_memory_back():
    for module in (toxicity, minhash, pii, bpe):
        source = Path(module.__file__).read_text()
        tasks = re.findall(r"((?: +@.*\n)*) +def \w+\(batches:", source)
        assert tasks and all("@handing_back" in marks for marks in tasks), module.__name__
