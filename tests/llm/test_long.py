"""Memory that one very long text costs a worker, measured in a process of its own; and that its result is that of its parts."""

import subprocess
import sys
from pathlib import Path

import pytest

#: Bytes of the text, and MB of memory besides it that each operator may take (the text is there two or three times).
SIZE = 24 << 20
LIMITS = {"op1": 520, "op2": 240, "op3": 200, "op3zh": 400, "op3cyr": 200, "op4": 320, "op6": 260, "op8": 480, "op9": 420, "op10": 480}

SCRIPT = """
import random, resource, sys
import numpy as np, pyarrow as pa
from addrloom.llm import audio, fingerprint, html_extract, neardup, quality, tokens, toxicity
from addrloom.llm.common import utf8

def peak():
    return resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024

what, size = sys.argv[1], int(sys.argv[2])
r = random.Random(1)
vocabulary = ["".join(r.choices("abcdefghijklmnop", k=r.randint(2, 9))) for _ in range(20000)]
part = " ".join(r.choices(vocabulary, k=200_000))
if what == "op3zh":
    part = "".join("".join(r.choices("你好世界今天气很我们去公园再见文章语言模型数据", k=r.randint(3, 25))) + r.choice("，。！") for _ in range(20_000))
elif what == "op3cyr":
    part = " ".join("".join(r.choices("абвгдежзиклмноп", k=r.randint(2, 9))) for _ in range(200_000))
text = " ".join([part] * (size // len(part.encode())))
col = pa.array([text])
off, data = utf8(col)
encoder = tokens.encoder(tokens.tokenizer_path("word_bpe_49k.json" if what[:3] == "op3" else "byte_bpe_50k.json")) if what[:3] in ("op3", "op4") else None
small = utf8(pa.array([part[:200_000]]))
if what == "op9":
    _, _, units = toxicity.read(*small)
    key = np.unique(units.key)
    value = np.random.default_rng(1).normal(0, 1, len(key)).astype(np.float32)
    model = toxicity.Model(toxicity.fresh(), toxicity.Vocabulary(key, value, np.full(len(key), -1, np.int32)), np.ones((toxicity.KINDS, toxicity.SIZE), np.float32), 1.0, 0.0)
before = peak()
if what == "op1":
    fingerprint.sketches([text])
elif what == "op2":
    media = pa.array([audio.wav(memoryview(data), len(data))], pa.binary())
    made = audio.features_of(pa.RecordBatch.from_arrays([pa.array([1]), media], ["doc_id", "media"]), True)
    size, crc = audio.pcm_digests(made.column("pcm"))
    assert size[0].as_py() == 4 * made.column("payload_bytes")[0].as_py() and f"pcm_crc={crc[0].as_py():08x}" in made.column("feature")[0].as_py()
elif what[:3] == "op3":
    n, _ = encoder.encode(off, data, with_ids=False)
    m, _ = encoder.encode(*utf8(pa.array([part])), with_ids=False)
    assert what == "op3zh" or n[0] == m[0] * (size // len(part.encode()))  # a space by a mark is a token of its own
elif what == "op4":
    n, ids = encoder.encode(off, data)
    assert len(ids) == n[0]
elif what == "op6":
    found, _ = html_extract.lines("<p>" + text.replace(" a", "</p><p>") + "</p>")
    assert len(found) > 1000
elif what == "op8":
    quality.statistics(off, data)
elif what == "op9":
    assert model.scores(col)[0] >= model.scores(pa.array([part]))[0] - 1e-6
elif what == "op10":
    (a,), (b,) = neardup.shingles(off, data), neardup.shingles(*utf8(pa.array([part + " " + part])))
    assert (a == b).all()
    neardup.signatures([a])
print(round(peak() - before))
"""


@pytest.mark.parametrize("what", LIMITS)
def test_a_long_text_costs_bounded_memory(what):
    root = str(Path(__file__).resolve().parents[2])
    run = subprocess.run([sys.executable, "-c", SCRIPT, what, str(SIZE)], cwd=root, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    assert int(run.stdout.split()[-1]) <= LIMITS[what]
