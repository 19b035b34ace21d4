"""Words and their hashes in blocks, and the memory of very long texts."""

import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from spelltide.llm import words as W


@pytest.mark.parametrize("size", [7, 16, 64, 1000])
def test_blocks_give_the_same_runs(monkeypatch, size):
    pick = random.Random(size)
    monkeypatch.setattr(W, "PIECE_BYTES", size)
    for trial in range(60):
        texts = ["".join(pick.choice("aB é \t中x") for _ in range(pick.choice([0, 1, 5, 40, 200]))) for _ in range(pick.randint(1, 8))]
        if trial % 5 == 0:
            texts[0] = "x" * pick.randint(1, 500)
        data, offsets = W.utf8(pa.array(texts))
        starts, ends, row = W.spans(~W.WHITE[data], offsets)
        found = list(W._open_runs(data, offsets, ~W.WHITE, W.LOWER)) or [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        assert (np.concatenate([f[0] for f in found]) == W.hashes(W.LOWER[data], starts, ends)).all()
        assert (np.concatenate([f[1] for f in found]) == row).all()


CODE = """
import resource, sys
import numpy as np, pyarrow as pa
from spelltide.llm import decontam, fm, katz, ngram_join, packing, secrets, words
size = int(sys.argv[2])
text = {"words": "lorem ipsum dolor 42 sit amet, consectetur AbC0Xy9z ", "one": "lorem", "secret": "token=abcdef1234 "}[sys.argv[3]]
column = pa.array([text * (size // len(text))])
data, offsets = words.utf8(column)
def peak():
    return resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024
before = peak()
if sys.argv[1] == "words":
    words.word_hashes(data, offsets)
elif sys.argv[1] == "fm":
    fm.features(data, offsets, np.array([np.nan]))
elif sys.argv[1] == "decontam":
    decontam.token_hashes(data, offsets)
elif sys.argv[1] == "secrets":
    model = secrets.SecretModel(np.zeros(secrets.SYMBOLS ** 3))
    secrets.scan_texts(data, offsets, column.to_pylist(), model)
    secrets._labelled(data, offsets, column.to_pylist())
print(peak() - before)
"""


@pytest.mark.parametrize("operator", ["words", "fm", "decontam", "secrets"])
@pytest.mark.parametrize("shape", ["words", "one"])
def test_a_long_text_needs_bounded_memory(operator, shape):
    """24 MB of one text, with words or as a single one, in less than 900 MB more than the text itself."""
    run = subprocess.run(
        [sys.executable, "-c", CODE, operator, str(24 << 20), shape], cwd=Path(__file__).parents[2], capture_output=True, text=True, timeout=300
    )
    assert not run.returncode, run.stderr
    assert float(run.stdout) < 900, run.stdout


def test_many_hits_take_linear_time():
    """Four times the hits of one text take no more than about four times as long."""
    import time

    from spelltide.llm import secrets

    model = secrets.SecretModel(np.zeros(secrets.SYMBOLS**3))

    def seconds(n):
        text = "é token=abcdef1234 Zq8kXv2LmP0sTr7YwB4nJc6H " * n
        data, offsets = W.utf8(pa.array([text]))
        start = time.process_time()
        found = secrets.scan_texts(data, offsets, [text], model)[0]
        secrets._labelled(data, offsets, [text])
        assert len(found) >= n
        return time.process_time() - start

    seconds(500)
    assert seconds(16_000) < 16 * max(seconds(2_000), 0.01)
