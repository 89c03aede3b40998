"""Each operator against a plain version, and on nulls, empty and long texts, repeats, empty tables and clashing columns."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from addrloom.llm import audio, components, fingerprint, html_extract, mixing, neardup, packing, quality, token_files, tokens, toxicity, words
from addrloom.llm.common import utf8

RNG = random.Random(5)
WORDS = ["alpha", "beta", "Gamma", "delta,", "eps.", "zeta", "eta", "theta", "iota!", "kappa", "lambda", "mu"]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + (str(r.randint(0, 99)) if r.random() < 0.3 else "") for _ in range(n))


LONG = prose(9000, 1)
TEXTS = [None, "", " ", "one", "one two three", prose(80, 2), prose(80, 2), prose(80, 2) + " tail", LONG, "Füße  zwei \n Räume <|endoftext|> it's", "日本語 テキスト", "a" * 3000, "\n\n", "tab\there"]
ROWS = [(k, t, None if k % 5 == 0 else f"s{k % 3}", 0.5, 7) for k, t in enumerate(TEXTS)] + [(3, "one", "s0", 0.5, 7), (None, "no id", None, 0.5, 7), (3, "one", "s0", 0.5, 7)]
SCHEMA = "doc_id long, text string, source string, score double, n long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"


def library(name):
    return tokens.encoder(tokens.tokenizer_path(name)).lib


def ids_of(name, text):
    return library(name).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", [WORD_BPE, BYTE_BPE])
@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.one_of(st.text(alphabet="aB é́ \n\t.,'s1<|>İΣß日 \x1c", max_size=30), st.text(max_size=20)), max_size=8))
def test_chunks_encode_as_the_library(name, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    tool = tokens.encoder(tokens.tokenizer_path(name))
    n, ids = tool.encode(*utf8(pa.array(texts, pa.string())))
    got = [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] if texts else []
    assert got == [ids_of(name, t) for t in texts]


def thue_morse(n, a, b):
    """The word over two letters and its complement, which every power-of-two polynomial takes for one."""
    x = [0]
    while len(x) < n:
        x += [1 - v for v in x]
    return ["".join((a, b)[v] for v in x[:n]), "".join((b, a)[v] for v in x[:n])]


@pytest.mark.parametrize("name", [WORD_BPE, BYTE_BPE])
def test_chunks_are_known_by_their_bytes(name):
    texts = [t for n in (1024, 2048, 4096) for t in thue_morse(n, "a", "q")] + ["x" * 15, "x" * 16, "x" * 15 + "y", "x" * 14 + "\0", "x" * 14]
    n, ids = tokens.ChunkEncoder(tokens.tokenizer_path(name)).encode(*utf8(pa.array(texts)))
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [ids_of(name, t) for t in texts]


@pytest.mark.parametrize("name", [WORD_BPE, BYTE_BPE])
def test_long_texts_are_cut_where_it_is_safe(name, monkeypatch):
    monkeypatch.setattr(tokens, "SEGMENT", 40)
    monkeypatch.setattr(tokens, "GROUP", 200)
    texts = [prose(400, 3), "a  b " * 60 + "c d " * 60, "é" * 300, "", "don't 's a\n\nb  c" * 30, "x y" * 90]
    n, ids = tokens.ChunkEncoder(tokens.tokenizer_path(name)).encode(*utf8(pa.array(texts)))
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [ids_of(name, t) for t in texts]
    begin, end, _, first = tokens.segments(*utf8(pa.array(texts)), 40, lambda *_: False)
    assert first[-1] == len(begin) > 40 and (end >= begin).all()


SCRIPTS = ["привет мир. Ещё слово, и ещё одно! Да", "你好，世界。今天天气很好！我们去公园。再见", "これはテストです、はい。もう一つ、日本語の文章！そう", "ภาษาไทย และ อังกฤษ. คำ", "سلام دنیا، این یک آزمون است. بله", "Füße, naïve; ça va? Oui", "a1,b2.c3 x,y", "हिन्दी भाषा, और शब्द।"]


@pytest.mark.parametrize("name", [WORD_BPE, BYTE_BPE])
def test_long_texts_of_all_scripts_are_cut(name, monkeypatch):
    monkeypatch.setattr(tokens, "SEGMENT", 64)
    monkeypatch.setattr(tokens, "GROUP", 300)
    r = random.Random(5)
    texts = [(x + r.choice(["", " ", "\n", "。"])) * 12 for x in SCRIPTS]
    for _ in range(60):
        words_ = [w for x in r.sample(SCRIPTS, 2) for w in x.split()]
        texts.append("".join(r.choice(words_) + r.choice(["", " ", "  ", ",", "。", " <|endoftext|>", "'s", "\t", "e\u0301", " \u0301", "İ,", "½ ", "\u3000"]) for _ in range(r.randint(5, 60))))
    tool = tokens.ChunkEncoder(tokens.tokenizer_path(name))
    n, ids = tool.encode(*utf8(pa.array(texts)))
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [ids_of(name, t) for t in texts]
    for t in texts[:5]:
        begin, end, _, _ = tokens.segments(*utf8(pa.array([t])), 64, tool._agreed)
        assert len(begin) > 3 and (end - begin).max() < 200, t


def test_table_survives_being_full(monkeypatch):
    monkeypatch.setattr(tokens, "POOL", 50)
    tool = tokens.ChunkEncoder(tokens.tokenizer_path(BYTE_BPE))
    for k in range(4):
        t = [prose(50, k), prose(20, k + 9)]
        _, ids = tool.encode(*utf8(pa.array(t)))
        assert ids.tolist() == [i for x in t for i in ids_of(BYTE_BPE, x)]


def test_token_counts(docs, nothing):
    got = sorted((r.doc_id is None, r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.count_tokens(docs, tokens.tokenizer_path(WORD_BPE)).collect())
    want = sorted((r[0] is None, r[0], len((r[1] or "").encode()), len(ids_of(WORD_BPE, r[1])), len(ids_of(WORD_BPE, r[1])) > 2048) for r in ROWS)
    assert got == want
    assert tokens.count_tokens(nothing, tokens.tokenizer_path(WORD_BPE)).count() == 0


def test_token_files_keep_order_and_ids(docs, nothing):
    files = token_files.write_token_files(docs, tokens.tokenizer_path(BYTE_BPE), end_id=2)
    got = sorted((r.start, r.n_tokens, r.ids_crc32, r.doc_id if r.doc_id is not None else -1) for r in token_files.read_digests(files).collect())
    start, want = 0, []
    for i, t, *_ in sorted(ROWS, key=lambda r: (r[0] is not None, r[0], r[1] or "")):
        ids = np.array([*ids_of(BYTE_BPE, t), 2], "<u4")
        want.append((start, len(ids), zlib.crc32(ids.tobytes()), i if i is not None else -1))
        start += len(ids)
    assert got == sorted(want)
    assert token_files.read_digests(token_files.write_token_files(nothing, tokens.tokenizer_path(BYTE_BPE), end_id=2)).count() == 0


def test_fingerprints_depend_on_the_text_alone(docs, nothing):
    texts = [t or "" for t in TEXTS]
    whole = fingerprint.sketches(texts)
    assert all((fingerprint.sketches([t])[0] == row).all() for t, row in zip(texts, whole, strict=True))
    inside = fingerprint.sketches([LONG, prose(40, 77) + LONG])
    assert fingerprint.likeness(inside[0], inside[1]) > 0.9 > 0.5 > fingerprint.likeness(inside[0], fingerprint.sketches([prose(500, 8)])[0])
    rows = fingerprint.fingerprint_pairs(docs).collect()
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0], r[1] or ""))
    t = [r[1] or "" for r in order]
    want = sorted((len(a), hashlib.sha256(fingerprint.edited(a, b).encode()).hexdigest(), fingerprint.to_hex(fingerprint.sketches([a]))[0]) for a, b in zip(t, t[1:] + t[:1], strict=True))
    assert sorted((r.n_chars, r.edited_sha256, r.fingerprint) for r in rows) == want
    assert fingerprint.fingerprint_pairs(nothing).count() == 0


def plain_phrases(names):
    """One level of locally consistent parsing of one text, name by name."""
    M = (1 << 64) - 1

    def mix(x):
        return int(fingerprint._mix(np.array([x & M], np.uint64))[0])

    runs = []
    for x in names:
        if runs and runs[-1][0] == x:
            runs[-1][1] += 1
        else:
            runs.append([x, 1])
    names = [x if n == 1 else mix(x + n * int(fingerprint._C[2])) for x, n in runs]

    def toss(left, own):
        d = left ^ own
        bit = (d & -d).bit_length() - 1 if d else 0
        return 2 * bit + (own >> bit & 1)

    label = [toss((names[k - 1] if k else ~x & M), x) for k, x in enumerate(names)]
    for _ in range(2):
        label = [toss(label[k - 1] if k else x ^ 1, x) for k, x in enumerate(label)]
    begin = [k for k in range(len(names)) if k == 0 or k < len(names) - 1 and label[k] > label[k - 1] and label[k] > label[k + 1]]
    out = []
    for a, b in zip(begin, [*begin[1:], len(names)], strict=False):
        out.append(mix(sum(x * int(fingerprint._POW[min(k, 63)]) for k, x in enumerate(names[a:b])) + int(fingerprint._C[2])))
    return out


def test_token_files_are_laid_out_for_selective_reads(spark, tmp_path):
    """Footers: dictionary ids, delta-encoded ascending columns, page indexes, several pages; a selection reads no ids."""
    from glob import glob

    import pyarrow.parquet as pq

    rows = spark.createDataFrame([(k, prose(60, k % 50)) for k in range(6000)], "doc_id long, text string").repartition(4)
    files = token_files.write_token_files(rows, tokens.tokenizer_path(BYTE_BPE), end_id=2)
    paths = glob(files._addrloom_path.removeprefix("file://") + "/*.parquet")
    assert paths
    for path in paths:
        meta = pq.ParquetFile(path).metadata
        for g in range(meta.num_row_groups):
            columns = {c.path_in_schema: c for c in (meta.row_group(g).column(k) for k in range(meta.num_columns))}
            assert meta.row_group(g).total_byte_size <= 40 << 20
            assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings and not columns["doc_id"].has_dictionary_page and "DELTA_BINARY_PACKED" in columns["start_in_range"].encodings
            ids = next(c for name, c in columns.items() if name.startswith("ids"))
            assert ids.has_dictionary_page and ids.compression == "ZSTD" and columns["doc_id"].has_offset_index and columns["doc_id"].has_column_index
    one = files.filter("doc_id = 4321").select("doc_id", "n_tokens")
    plan = one._jdf.queryExecution().toString()
    assert "ReadSchema: struct<doc_id:bigint,n_tokens:bigint>" in plan and "EqualTo(doc_id,4321)" in plan
    assert [tuple(r) for r in one.collect()] == [(4321, len(ids_of(BYTE_BPE, prose(60, 4321 % 50))) + 1)]
    whole = files.orderBy("range", "start_in_range").select("doc_id").collect()
    assert [r.doc_id for r in whole] == list(range(6000))


@settings(max_examples=60, deadline=None)
@given(text=st.one_of(st.text(max_size=80), st.text(alphabet="ab", max_size=120), st.text(alphabet="a", max_size=30)), sizes=st.lists(st.integers(1, 9), min_size=1, max_size=4))
def test_parsing_equals_a_plain_version_and_itself_in_pieces(text, sizes):
    want = whole = fingerprint._codes(text)
    off = np.array([0, len(whole)])
    pieces, at, k = [], 0, 0
    while at < len(whole):
        pieces.append(whole[at : at + sizes[k % len(sizes)]])
        at, k = at + sizes[k % len(sizes)], k + 1
    parts = iter(pieces)
    for _ in range(3):
        whole, off = fingerprint.next_level(whole, off)
        want, parts = plain_phrases([int(x) for x in want]), fingerprint.next_level_in_pieces(parts)
        assert whole.tolist() == want
    assert np.concatenate([np.zeros(0, np.uint64), *parts]).tolist() == want


def test_likeness_of_pairs_and_long_texts(docs, monkeypatch):
    """near_edited and near_next follow the share of a text that stays, and don't depend on how it is cut."""
    r = random.Random(60)  # words of random letters: unrelated texts share no phrases by chance of a small vocabulary
    t = [" ".join("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(400)) for _ in range(3)]
    half = " ".join([*t[0].split()[:200], *t[1].split()[200:]])
    for a, b, true in ((t[0], t[0], 1), (t[0], half, 0.5), (t[0], fingerprint.edited(t[0], t[1]), 0.75), (t[0], t[2], 0)):
        x, y = fingerprint.sketches([a, b])
        assert fingerprint.likeness(x, y) == pytest.approx(true, abs=0.2)
    whole = [tuple(r) for r in fingerprint.fingerprint_pairs(docs).collect()]
    for r, (a, b) in zip(sorted(whole, key=lambda r: (r[0] is not None, r[0])), zip(order := sorted(ROWS, key=lambda r: (r[0] is not None, r[0], r[1] or "")), order[1:] + order[:1], strict=True), strict=True):
        if [x[0] for x in ROWS].count(r[0]) == 1:
            x, y, z = fingerprint.sketches([a[1] or "", fingerprint.edited(a[1] or "", b[1] or ""), b[1] or ""])
            assert r[5:] == (fingerprint.likeness(x, y), fingerprint.likeness(x, z))
    texts = [u or "" for u in TEXTS]
    want = fingerprint.sketches(texts)
    monkeypatch.setattr(fingerprint, "TOGETHER", 100)
    assert (fingerprint.sketches(texts) == want).all()


def test_ranges_follow_ids_and_hold_like_bytes(spark):
    from addrloom.llm.common import ordered_ranges

    rows = [(None, "x")] + [(k, "y" * (2000 if 300 <= k < 340 else 50)) for k in range(600)] + [(7, "again")] * 5
    df, ranges = ordered_ranges(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), "doc_id", "text", 10_000)
    got = df.collect()
    assert sorted((r.doc_id or -1, len(r.text)) for r in got) == sorted((i or -1, len(t)) for i, t in rows)
    by = {p: [r for r in got if r._p == p] for p in range(ranges)}
    assert 8 <= ranges <= 40 and max(sum(len(r.text) for r in v) for v in by.values()) <= 25_000
    ends = [(min(r.doc_id if r.doc_id is not None else -1 for r in v), max(r.doc_id if r.doc_id is not None else -1 for r in v)) for _, v in sorted(by.items()) if v]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:], strict=False))


def test_tables_are_not_kept_on_a_machine_of_a_cluster():
    from types import SimpleNamespace

    from addrloom.llm.common import shared_dir

    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError, match="checkpoint.dir"):
        shared_dir(fake)


def test_without_a_checkpoint_folder_tables_go_to_the_warehouse():
    from types import SimpleNamespace

    from addrloom.llm.common import shared_dir

    def at(master, warehouse):
        return shared_dir(SimpleNamespace(conf=SimpleNamespace(get={"spark.checkpoint.dir": "", "spark.sql.warehouse.dir": warehouse}.get), sparkContext=SimpleNamespace(master=master)))

    assert at("spark://host:7077", "hdfs://names/warehouse/") == "hdfs://names/warehouse"
    assert at("spark://host:7077", "file:/mnt/shared/tables") == "file:/mnt/shared/tables"
    assert at("local-cluster[3,4,10240]", "file:/home/me/spark-warehouse") == "file:/home/me/spark-warehouse"
    with pytest.raises(ValueError, match="checkpoint.dir"):
        at("spark://host:7077", "file:/home/me/spark-warehouse")


def test_edited_text():
    assert fingerprint.edited("abcdefgh", "XYZ") == "abcdefXY" and fingerprint.edited("abcdefgh", "") == "abcdef" and fingerprint.edited("", "x") == ""


def scalar_adpcm(block):
    now = int.from_bytes(block[:2], "little", signed=True)
    index, out = min(block[2], 88), [now]
    for byte in block[4:]:
        for n in (byte & 15, byte >> 4):
            step = int(audio.IMA_STEPS[index])
            d = (step >> 3) + (step if n & 4 else 0) + (step >> 1 if n & 2 else 0) + (step >> 2 if n & 1 else 0)
            now = max(-32768, min(32767, now - d if n & 8 else now + d))
            index = max(0, min(88, index + int(audio.IMA_INDEX[n & 7])))
            out.append(now)
    return out


def test_audio_tables_blocks_and_round_trip(docs, nothing):
    assert (audio.MU_LAW[0], audio.MU_LAW[0x80], audio.MU_LAW[0xFF], audio.A_LAW[0x55], audio.A_LAW[0xD5], audio.A_LAW[0x2A]) == (-32124, 32124, 0, -8, 8, -32256)
    blocks = np.random.default_rng(1).integers(0, 256, (5, 192), np.uint8)
    assert [r.tolist() for r in audio.decode_adpcm(blocks)] == [scalar_adpcm(b.tobytes()) for b in blocks]
    media = audio.store_telephony(docs)
    by = {}
    for r in audio.telephony_features(media, keep_pcm=True).collect():
        by.setdefault(r.doc_id, []).append(r)
    for i, t, *_ in ROWS:
        raw = (t or "").encode()
        payload = raw + b" " * (max(192, -(-len(raw) // 192) * 192) - len(raw))
        r = by[i][0]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        m = audio.wav(payload, len(raw))
        assert (r.media_bytes, r.media_sha256) == (len(m), hashlib.sha256(m).hexdigest())
        assert (audio.unpack_pcm(r.pcm)[::2] == audio.MU_LAW[np.frombuffer(payload, np.uint8)]).all()
    from addrloom.llm.common import stored

    kept = audio.read_features(stored(audio.telephony_features(stored(media, **audio.LAYOUT), keep_pcm=True), **audio.LAYOUT)).collect()
    assert sorted((r.doc_id or -1, r.media_sha256, r.pcm_crc32, r.pcm_bytes) for r in kept) == sorted((i or -1, r.media_sha256, zlib.crc32(audio.unpack_pcm(r.pcm)), len(r.pcm)) for i, x in by.items() for r in x)
    noise = np.random.default_rng(2).integers(-32768, 32768, 400).astype(np.int16)
    assert (audio.unpack_pcm(audio.pack_pcm(noise)) == noise).all()
    assert all(f"pcm_crc={r.pcm_crc32:08x}" in r.feature and r.pcm_bytes == 4 * r.payload_bytes for r in kept)
    assert by[5][0].feature == by[6][0].feature and audio.telephony_features(audio.store_telephony(nothing)).count() == 0


def test_slices_of_a_recording_are_the_whole(monkeypatch):
    r = np.random.default_rng(5)
    media = [audio.wav(r.integers(0, 256, n, np.uint8).tobytes(), n) for n in (5000, 1, 192, 7000)]
    b = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4, 5]), pa.array([*media[:2], None, *media[2:]], pa.binary())], ["doc_id", "media"])
    whole = audio.features_of(b, True)
    monkeypatch.setattr(audio, "SLICE", 3 * 192)
    assert audio.features_of(b, True).equals(whole) and audio.features_of(b, False).equals(whole.drop_columns(["pcm"]))
    assert pa.concat_tables([pa.Table.from_batches([audio.features_of(b.slice(k, 1), True)]) for k in range(5)]).equals(pa.Table.from_batches([whole]))
    size, crc = audio.pcm_digests(whole.column("pcm"))
    for k, x in enumerate(b.column("media").to_pylist()):
        if x is None:
            assert size[k].as_py() is None and whole.column("pcm")[k].as_py() is None
            continue
        # Plainly: interpolation sample by sample, the last one held.
        even = [int(v) for v in audio.MU_LAW[np.frombuffer(audio.read_wav(x)[0], np.uint8)]]
        pcm = np.array([v for p, q in zip(even, [*even[1:], even[-1]], strict=True) for v in (p, p + q >> 1)], "<i2")
        assert (crc[k].as_py(), size[k].as_py()) == (zlib.crc32(pcm.tobytes()), pcm.nbytes) and (audio.unpack_pcm(whole.column("pcm")[k].as_py()) == pcm).all()
        assert f"crossings={sum((p < 0) != (q < 0) for p, q in zip(even, even[1:], strict=False))};" in whole.column("feature")[k].as_py()


def test_mix_equals_sql(spark, docs, nothing):
    key = lambda r: (-1 if r[0] is None else r[0], *r[1:])
    got = sorted((tuple(r) for r in mixing.mix(mixing.sizes(docs)).collect()), key=key)
    documents = pa.Table.from_pylist([dict(zip(["doc_id", "text", "source"], r, strict=False)) for r in ROWS], pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("source", pa.string())]))
    con = duckdb.connect()
    con.register("documents", documents)
    want = con.sql(mixing.mix_sql())
    assert want.columns == ["doc_id", "size", "source_size", "target", "taken"]
    assert got == sorted(want.fetchall(), key=key) and all(r[4] <= 2 * r[1] for r in got)
    assert mixing.mix(mixing.sizes(nothing)).count() == 0
    copies = mixing.mixed_documents(docs)
    assert copies.columns == docs.columns
    words = sum(len([w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", r.text or "")]) for r in copies.collect())
    assert words == sum(r[4] for r in got)


@pytest.mark.parametrize("few", [100_000, 0])
def test_targets_equal_stepwise_resharing(spark, monkeypatch, few):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", few)
    assert mixing.targets(spark.createDataFrame([], "source string, source_size long")).count() == 0
    for seed in range(5):
        r = random.Random(seed)
        size = {f"s{k}": r.choice([0, 1, 10, 100, 5000]) for k in range(7)}
        weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(size))}
        total, capped = 1.5 * sum(size.values()), set()
        while True:
            rest = total - sum(2 * size[s] for s in capped)
            open_ = [s for s in size if s not in capped]
            share = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
            over = {s for s in open_ if share[s] > 2 * size[s]}
            if not over:
                break
            capped |= over
        want = {s: 2 * size[s] if s in capped else share[s] for s in size}
        got = {x.source: x.target for x in mixing.targets(spark.createDataFrame(list(size.items()), "source string, source_size long").repartition(3)).collect()}
        assert got == pytest.approx(want)


def kept_lines(page):
    return [t for t, kind in html_extract.lines(page)[0] if kind != html_extract.GONE]


def test_html_blocks_and_structure():
    page = "<html><head><title>T</title></head><body><header>Site</header><nav>m<ul><li>a</ul></nav><div class='cookie-notice'>C</div><article><header><h1>H &amp; h</h1></header><p>One <b>two</b>\n three<p class=ad>Buy<p>Four<br>five<script>var a='<p>no'</script><!-- x --><form>f<input></form><section id=comments>me</section></article><aside>s</aside><footer>f</footer>"
    assert kept_lines(page) == ["H & h", "One two three", "Four five"] and html_extract.lines(page)[1]
    assert html_extract.lines("") == ([], False)
    assert kept_lines("a < b <p> &lt;i&gt;&nbsp;c") == ["a < b", "<i> c"]
    assert kept_lines("<div class=ad>x<article><p>y</article>") == ["y"]
    assert kept_lines("<div class='site-header'>S</div><div class='post-header'><h2 class=header>T</h2></div><p class=byline>By A</p><div id=reader-comments><p>c</div><div role=navigation>n</div><p>e</p>") == ["T", "By A", "e"]
    assert kept_lines("<article><p>a</p><div class='comment-list'><article><p>reply</p></article></div><p>b</p><script>'</article>'</script></article>") == ["a", "b"]


def test_html_attributes_are_read_as_such():
    assert kept_lines('<article><p title="a hidden valley">First paragraph.</p><p data-id="share">Second.</p><p hidden>no</p></article>') == ["First paragraph.", "Second."]
    found, _ = html_extract.lines('<article><h2 id="related-work">R</h2><div class="social history"><p>x</p></div><p>One <a class=share>SHARE</a> two</p><div>bare</div><p><a href=x>all link</a></p></article><p>out</p>')
    assert found == [("R", html_extract.SURE), ("x", html_extract.OPEN), ("One two", html_extract.SURE), ("bare", html_extract.OPEN), ("all link", html_extract.OPEN), ("out", html_extract.GONE)]
    assert kept_lines("<article><p>a <span class=ad>buy <b>now</b></span> b<p>c") == ["a b", "c"]
    assert kept_lines("<article><p>a <script>'<p>'</script>b<style>p{}</style> c</p><p>d") == ["a b c", "d"]
    found, _ = html_extract.lines('<article><div class="social history"><p>x</p><nav>menu</nav><div><p>y</p></div></div><p>z</p><ul><li class="notice board">n<li>o</ul></article>')
    assert found == [("x", html_extract.OPEN), ("menu", html_extract.GONE), ("y", html_extract.OPEN), ("z", html_extract.SURE), ("n", html_extract.OPEN), ("o", html_extract.SURE)]


@pytest.mark.parametrize("bits", [1 << 27, 8])
@settings(max_examples=100, deadline=None)
@given(a=st.lists(st.integers(0, 4), max_size=12), b=st.lists(st.integers(0, 4), max_size=12))
def test_shared_is_a_longest_common_subsequence(bits, a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    got = html_extract.shared(a, b, bits)
    assert len(got) == best[-1][-1] and all(a[i] == b[j] for i, j in got)
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:], strict=False))


def test_long_pages_are_compared_within_bounds():
    r = random.Random(1)
    a = [r.randrange(60000) for _ in range(20000)]
    b = [x for x in a if r.random() < 0.9]
    assert len(html_extract.shared(a, b, 1 << 24)) == len(b)


def plain_pages(rows):
    """Text of each page by comparing all pages of a host: of its distinct contents in URL order the next ones that aren't copies, the nearer one's shared open lines deleted."""
    from itertools import groupby

    read = {}
    for i, url, page in rows:
        found, _ = html_extract.lines(page or "")
        read[i] = (*html_extract._address(url), tuple(html_extract._number(t) for t, _ in found), tuple(k for k, (_, kind) in enumerate(found) if kind == html_extract.OPEN), found)
    out = {}
    for host in {r[0] for r in read.values()}:
        own = [r for r in read.values() if r[0] == host]
        content = {(r[2], r[3]) for r in own}
        entries = sorted((min(r[1] for r in own if (r[2], r[3]) == c), c, next(r[4] for r in own if (r[2], r[3]) == c)) for c in content)
        sizes = [[len(t) if kind != html_extract.GONE else 0 for t, kind in e[2]] for e in entries]
        both = lambda x, y: html_extract.shared(list(entries[x][1][0]), list(entries[y][1][0]))
        copy = lambda x, y: html_extract.is_copy(sizes[x], [i for i, _ in both(x, y)])
        gone = {}
        for x, (path, (numbers, open_), _) in enumerate(entries):
            def near(step, x=x):
                y = x + step
                if 0 <= y < len(entries) and not copy(x, y):
                    return [y]
                while 0 <= y < len(entries) and (copy(y - step, y) or copy(y, y - step)):
                    y += step
                return [y] if 0 <= y < len(entries) and not copy(x, y) else []

            beside = [y for y in (x - 1, x + 1) if 0 <= y < len(entries) and not copy(x, y)] or near(-1) + near(1)
            if beside and open_:
                options = [(html_extract.nearness(path, entries[y][0]), [i for i, _ in both(x, y) if i in open_]) for y in beside]
                gone[entries[x][1]] = max(options, key=lambda o: (o[0], -len(o[1]), o[1]))[1]
        for i, r in read.items():
            if r[0] == host:
                drop = gone.get((r[2], r[3]), [])
                out[i] = "\n".join(t for k, (t, kind) in enumerate(r[4]) if kind != html_extract.GONE and k not in drop)
    return out


def extracted(spark, rows):
    return {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()}


def test_pages_lose_what_their_neighbours_share(spark):
    body = lambda k: f"<body><div>Welcome to our site</div><p>Own text {k} of this page</p><p>More words {k}</p><div>Call us now</div></body>"
    rows = [(k, f"http://h.example/a/{k}", body(k)) for k in range(6)] + [(6, None, None), (7, "http://lone.example/x", body(7)), (8, "http://h.example/a/0", body(0)), (9, "::bad[", "")]
    got = extracted(spark, rows)
    assert len(got) == 10 and got[6] == got[9] == "" and got == plain_pages(rows)
    assert all(got[k] == f"Own text {k} of this page\nMore words {k}" for k in range(6)) and got[8] == got[0]
    assert got[7].startswith("Welcome")
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_differencing_equals_a_plain_version(spark):
    """Marked and unmarked pages, menus in heavy markup, runs of near copies, repeated ids, on several hosts."""
    r = random.Random(31)
    menu = "".join(f"<div>{w} menu</div>" for w in WORDS[:7])
    rows = []
    for k in range(90):
        host, text = f"http://h{k % 3}.example", "".join(f"<p>{prose(25, 1000 + k * 9 + j)}</p>" for j in range(r.randint(1, 3)))
        kind = k % 5
        if kind == 0:
            page = f"{menu}<article>{text}<div>Follow us</div><p><a href=x>Read next</a></p></article><div>foot</div>"
        elif kind == 1:
            page = f"{menu}<p>short {k}</p><div>foot</div>"
        else:
            page = f"{menu}{text}<div>Follow us</div><div>foot</div>"
        rows.append((k, f"{host}/{kind}/{k:03d}", page))
    long = "".join(f"<p>{prose(40, 5000 + j)}</p>" for j in range(5))
    rows += [(200 + k, f"http://h1.example/2/near{k:02d}", f"{menu}{long}<p>version {k}</p><div>foot</div>") for k in range(12)]  # a run of near copies
    rows += [(5, "http://h2.example/2/005", "<p>another page with this id</p>"), (300, "http://h0.example/x", None)]
    rows = list({i: (i, u, p) for i, u, p in rows}.values())
    got = extracted(spark, rows)
    assert got == plain_pages(rows)
    assert all("menu" not in got[200 + k] and got[200 + k].endswith(f"version {k}") for k in range(12))
    assert got[0].count("\n") < 4 and "Follow us" not in got[10]


def test_page_columns_and_repeated_ids(spark):
    x, y = "<p>The own text of one page</p><p>same</p>", "<p>And that of the other page</p><p>same</p>"
    rows = [(1, "http://a.example/1", x, "t", 5), (1, "http://a.example/2", y, None, 6), (None, "http://a.example/2", y, None, 6)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string, rank int"))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.text) for r in got.collect()) == [(0, "And that of the other page"), (1, "And that of the other page"), (1, "The own text of one page")]


def check_packing(rows, capacity):
    at = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert all(n <= capacity for n in at.values())
    return len(at)


def test_packing(docs, nothing):
    p = packing.pieces(docs, tokens.tokenizer_path(WORD_BPE), end_id=1)
    rows = packing.pack(p).collect()
    want = []
    for i, t, *_ in ROWS:
        ids = np.array([*ids_of(WORD_BPE, t), 1], "<u4")
        want += [(i, k, 4096 * k, len(x), zlib.crc32(x.tobytes())) for k, x in ((k, ids[4096 * k : 4096 * (k + 1)]) for k in range(-(-len(ids) // 4096)))]
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted(map(key, [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows])) == sorted(map(key, want))
    check_packing(rows, 4096)
    assert packing.pack(packing.pieces(nothing, tokens.tokenizer_path(WORD_BPE), end_id=1)).count() == 0


def test_groups_and_rounds_waste_little(spark):
    r = random.Random(2)
    n = [r.choice([r.randint(1, 4096), r.randint(1, 600)]) for _ in range(1500)]
    df = spark.createDataFrame([(k, 0, 0, x, 0) for k, x in enumerate(n)], packing.PIECE)
    used = check_packing(packing.pack(df, group=200).collect(), 4096)
    assert used <= -(-sum(n) // 4096) * 1.03 + 2


@settings(max_examples=60, deadline=None)
@given(n=st.lists(st.integers(1, 100), min_size=1, max_size=40))
def test_refining_never_adds_bins(n):
    n = np.array(n)
    first = packing.best_fit(n, 100)
    after = packing.refine(n, first, 100)
    fill = np.bincount(after, n)
    assert fill.max() <= 100 and (fill > 0).sum() <= len(set(first.tolist()))


def test_refining_swaps_to_empty_a_bin():
    n = np.array([60, 40, 55, 30, 15])  # bins (60, 30), (55, 40), (15): one exchange and a move save a bin
    where = np.array([0, 1, 1, 0, 2])
    assert len(set(packing.refine(n, where, 100).tolist())) == 2


def test_refining_runs_until_no_step_is_left():
    n = np.repeat([1800, 1200, 1096], 700)  # fit in 700 full bins
    first = packing.best_fit(n)
    after = packing.refine(n, first)
    assert len(set(first.tolist())) > 800 and np.bincount(after, n).max() <= 4096
    assert len(set(after.tolist())) == 700


def test_rounds_go_on_while_they_save_bins(spark):
    n = np.repeat([1800, 1200, 1096], 100).tolist()
    random.Random(4).shuffle(n)
    df = spark.createDataFrame([(k, 0, 0, x, 0) for k, x in enumerate(n)], packing.PIECE)
    rows = packing.pack(df, group=60).collect()
    assert sorted(r.length for r in rows) == sorted(n) and check_packing(rows, 4096) <= 103


def test_forest_learns_and_handles_one_class():
    r = np.random.default_rng(3)
    x = r.normal(size=(600, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    f = quality.fit(x[:400], y[:400])
    assert ((f.score(x[400:]) > 0.5) == y[400:]).mean() > 0.93
    assert (quality.fit(x[:10], np.ones(10)).score(x) > 0.9).all() and len(quality.fit(x[:0], y[:0]).score(x)) == 600


def plain_statistics(text):
    """The features of one text, spelled out."""
    import math
    from itertools import pairwise

    raw = text.encode()
    kinds = {"lower": "abcdefghijklmnopqrstuvwxyz", "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": "0123456789", "blank": " \t\r\v\f", "newline": "\n", "stop": ".,", "cry": "!?", "bar": "|", "junk": "%$*&#@~^_=+<>\\"}
    share = [sum(chr(c) in v for c in raw if c < 128) / max(1, len(raw)) for v in kinds.values()] + [sum(c >= 128 for c in raw) / max(1, len(raw))]
    w, lines = raw.split(), text.split("\n")
    rest = [0.0] * 10
    if w:
        rest = [math.log1p(len(w)), len(text) / len(w), len(set(w)) / len(w), max(w.count(x) for x in w) / len(w), sum(a == b for a, b in pairwise(w)) / len(w), len(set(pairwise(w))) / max(len(w) - 1, 1),
                math.log1p(len(lines)), len(set(lines)) / len(lines), math.log1p(len(text) / len(lines)), sum(not (x[-1:].isalnum() or x[-1] >= 128) for x in w) / len(w)]
    return [*share, math.log1p(len(raw)), *rest]


def test_statistics_equal_a_plain_version():
    texts = [t or "" for t in TEXTS if t is not LONG] + ["A!? b|c %%\n\nA!? é", "x"]
    assert quality.statistics(*utf8(pa.array(texts))) == pytest.approx(np.array([plain_statistics(t) for t in texts]))


def plain_boosting(x, y, trees, depth):
    """Scores of the training rows by the same boosting, node by node and cut by cut."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, quality.BINS + 1)[1:-1], method="lower")) for c in x.T]
    p0 = (y.sum() + 0.5) / (len(y) + 1)
    raw = np.full(len(y), np.log(p0 / (1 - p0)))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)

        def value(rows):
            return g[rows].sum() ** 2 / (h[rows].sum() + quality.RIDGE)

        def grow(rows, d):
            if d == depth:
                raw[rows] -= quality.RATE * g[rows].sum() / (h[rows].sum() + quality.RIDGE)
                return
            best = (1e-6, None, None)
            for j in range(x.shape[1]):
                for c in cuts[j]:
                    left = x[rows, j] <= c
                    if min(left.sum(), (~left).sum()) >= quality.LEAST_ROWS:
                        gain = value(rows[left]) + value(rows[~left]) - value(rows)
                        if gain > best[0] + 1e-12:
                            best = (gain, j, c)
            if best[1] is None:
                return grow(rows, depth)
            left = x[rows, best[1]] <= best[2]
            grow(rows[left], d + 1)
            grow(rows[~left], d + 1)

        grow(np.arange(len(y)), 0)
    return 1 / (1 + np.exp(-raw))


def test_forest_equals_plain_boosting_and_a_plain_walk():
    r = np.random.default_rng(7)
    x = np.round(r.normal(size=(150, 3)), 2)
    y = ((x[:, 0] > 0.2) ^ (r.random(150) < 0.1)).astype(float)
    f = quality.fit(x, y, trees=5, depth=3)
    assert f.score(x) == pytest.approx(plain_boosting(x, y, 5, 3))

    def walk(row):
        total = f.base
        for column, cut, leaf in zip(f.column, f.cut, f.leaf, strict=True):
            at = 0
            while at < len(column):
                at = 2 * at + 1 + int(row[column[at]] > cut[at])
            total += leaf[at - len(column)]
        return 1 / (1 + np.exp(-total))

    new = r.normal(size=(50, 3))
    assert f.score(new) == pytest.approx([walk(v) for v in new])


def test_quality_learns_an_id_once(spark):
    table = [(k, prose(30, k) + (" %%%" * 20 if k % 3 == 0 else "")) for k in range(90)]
    labels = spark.createDataFrame([(k, int(k % 3 != 0)) for k in range(90)], "doc_id long, quality int")
    once = quality.train(spark.createDataFrame(table, "doc_id long, text string"), labels)
    many = quality.train(spark.createDataFrame(table * 3 + [(None, "x")], "doc_id long, text string").repartition(5), labels)
    assert (once.cut == many.cut).all() and (once.leaf == many.leaf).all()
    rows = quality.labelled(spark.createDataFrame([(1, f"text {k}") for k in range(50)], "doc_id long, text string"), labels, "quality", 4, 2, 10)
    assert rows.count() <= 1


def test_quality_held_out_and_edges(spark, docs, nothing):
    good, bad = [prose(60, k) for k in range(150)], [" ".join(["junk%%%"] * 20 + [w + "$$$" for w in prose(30, k).split()]) for k in range(60)]
    table = spark.createDataFrame(list(enumerate(good + bad)), "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k < 150)) for k in range(210)] + [(5, None), (6, 1)], "doc_id long, quality int")
    forest = quality.train(table, labels)
    rows = quality.score_documents(table, lambda t: quality.text_scores(forest, t), 4, 2).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == int(r.doc_id < 150) for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in quality.score_documents(docs, lambda t: quality.text_scores(forest, t), 4, 2).collect())
    kept = quality.keep_documents(docs, lambda t: quality.text_scores(forest, t) >= 0.0)
    assert kept.columns == docs.columns and kept.count() == len(ROWS)
    empty = quality.train(nothing, labels.limit(0))
    assert quality.score_documents(nothing, lambda t: quality.text_scores(empty, t), 4, 2).count() == 0


def test_network_gradients():
    r = np.random.default_rng(0)
    w = {k: v.astype(np.float64) for k, v in toxicity.fresh().items()}
    raw, mask = r.normal(0, 1, (6, 5, toxicity.INPUTS)), np.ones((6, 5))
    mask[4:, 2] = mask[:, 3] = 0
    raw *= mask[:, :, None]
    y = np.array([1, 0, 1, 0, 1.0])
    _, g, of_inputs = toxicity.gradients(w, raw, mask, y)
    for k in w:
        i = tuple(r.integers(0, n) for n in w[k].shape)
        loss = []
        for e in (1e-4, -1e-4):
            v = w | {k: w[k].copy()}
            v[k][i] += e
            loss.append(toxicity.gradients(v, raw, mask, y)[0])
        assert g[k][i] == pytest.approx((loss[0] - loss[1]) / 2e-4, abs=1e-5)
    for i in ((0, 0, 1), (3, 1, 7), (5, 4, toxicity.INPUTS - 1)):
        loss = []
        for e in (1e-4, -1e-4):
            v = raw.copy()
            v[i] += e
            loss.append(toxicity.gradients(w, v, mask, y)[0])
        assert of_inputs[i] == pytest.approx((loss[0] - loss[1]) / 2e-4, abs=1e-5)


def small_network(seed=1):
    """A model with random weights and embeddings for the words of TEXTS."""
    r = np.random.default_rng(seed)
    _, _, units = toxicity.read(*utf8(pa.array([t or "" for t in TEXTS])))
    key = np.unique(units.key)
    own = np.where(r.random(len(key)) < 0.7, np.arange(len(key)) + toxicity.KINDS, -1).astype(np.int32)
    embedding = r.normal(0, 1, (len(key) + toxicity.KINDS, toxicity.SIZE)).astype(np.float32)
    return toxicity.Model(toxicity.fresh(seed), toxicity.Vocabulary(key, r.normal(0, 1, len(key)).astype(np.float32), own), embedding, 1.3, -0.4)


def plain_score(m, text):
    """The score of one text, word by word and window by window."""
    import math
    import re

    low = bytes(c + 32 if 65 <= c <= 90 else c for c in toxicity.lowered(np.frombuffer((text or "").encode(), np.uint8)).tobytes()).decode()
    found = re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", low)
    place = {int(k): j for j, k in enumerate(m.vocabulary.key)}

    def one(piece, kind, plus):
        raw = np.frombuffer(piece.encode(), np.uint8)
        k = int((toxicity.words.keys(raw, np.array([0]), np.array([len(raw)])) + np.uint64(plus))[0])
        j = place.get(k)
        row = kind if j is None or m.vocabulary.own[j] < 0 else m.vocabulary.own[j]
        return [0.0 if j is None else float(m.vocabulary.value[j]), *m.embedding[row].astype(float)]

    def vector(word):
        x = one(word, 0, 0) + one(word[:3], 1, 3) + one(word[:4], 2, 4) + one(word[:5], 3, 5)
        grams = [one(word[k : k + 3], 4, 9) for k in range(len(word) - 2)]
        return np.array(x + ([max(g[0] for g in grams), *np.mean([g[1:] for g in grams], 0)] if grams else [0.0] * (1 + toxicity.SIZE)))

    w, h = m.weights, toxicity.HIDDEN
    sig = lambda v: 1 / (1 + np.exp(-v))

    def states(xs, d):
        state, out = np.zeros(h), []
        for x in xs if d == "f" else xs[::-1]:
            p, u = x @ w[f"W{d}"] + w[f"c{d}"], state @ w[f"U{d}"]
            z, r = sig(p[:h] + u[:h]), sig(p[h : 2 * h] + u[h : 2 * h])
            state = (1 - z) * state + z * np.tanh(p[2 * h :] + r * u[2 * h :])
            out.append(state)
        return out if d == "f" else out[::-1]

    xs, best = [vector(x) for x in found], -math.inf
    for a in range(0, max(1, len(xs) - (toxicity.WINDOW - toxicity.STRIDE)), toxicity.STRIDE):
        win = xs[a : a + toxicity.WINDOW]
        logit = float(w["b"][0])
        if win:
            hs = np.concatenate([states(win, "f"), states(win, "b")], 1)
            e = np.exp(np.tanh(hs @ w["A"]) @ w["a"])
            logit += float((e / e.sum()) @ hs @ w["o"])
        best = max(best, logit)
    return float(sig(m.scale * best + m.shift))


def test_toxicity_scores_equal_a_plain_walk_over_all_windows(monkeypatch):
    m = small_network()
    texts = [*TEXTS, prose(300, 44), *thue_morse(2048, "a", "q"), "ÀÉß × Ünder"]
    want = [plain_score(m, t) for t in texts]
    assert m.scores(pa.array(texts)) == pytest.approx(want, abs=1e-5)
    monkeypatch.setattr(toxicity, "TOGETHER", 64)  # long texts in pieces
    assert m.scores(pa.array(texts)) == pytest.approx(want, abs=1e-5)


def test_windows_cover_all_words():
    for n in (0, 1, 31, 32, 33, 48, 49, 500):
        begin, text = toxicity.windows(np.array([0, n, n + 3]))
        seen = {k for b, t in zip(begin, text, strict=True) if t == 0 for k in range(b, min(b + toxicity.WINDOW, n))}
        assert seen == set(range(n)) and (text == 1).sum() == 1


def test_toxicity_held_out_and_edges(spark, docs, nothing):
    r = random.Random(4)

    def text(k, toxic):
        w = prose(r.randint(20, 200), k).split()
        for _ in range(3 * toxic):
            w.insert(r.randint(0, len(w)), r.choice(["scoundrel", "Rascal!", "scoundrels", "rascally"]))
        return " ".join(w)

    table = [(k, text(k, k % 4 == 0)) for k in range(400)]
    df = spark.createDataFrame(table, "doc_id long, text string")
    model = toxicity.train(df, spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(400)], "doc_id long, toxic int"))
    rows = quality.score_documents(df, model.scores, 3, 1).collect()
    held = [x for x in rows if x.held_out]
    assert sum(x.predicted == int(x.doc_id % 4 == 0) for x in held) / len(held) > 0.95
    late = LONG + " rascal scoundrel rascal"
    s = model.scores(pa.array([LONG, late, "", None, "..."]))
    assert s[1] >= 0.7 > s[0] and s[2] == s[3] == s[4] < 0.7
    assert len(quality.score_documents(docs, model.scores, 3, 1).collect()) == len(ROWS)
    assert (model.vocabulary.own >= 0).any() and len(model.embedding) > toxicity.KINDS
    again = toxicity.train(df.unionByName(df).repartition(5), spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(400)], "doc_id long, toxic int"))
    assert (again.embedding == model.embedding).all()  # repeated rows count once
    none = toxicity.train(nothing, spark.createDataFrame([], "doc_id long, toxic int"))
    assert quality.score_documents(nothing, none.scores, 3, 1).count() == 0


def test_cross_validation_keeps_to_training_rows(spark, nothing):
    r = random.Random(8)
    table = [(k, prose(r.randint(20, 60), k) + " scoundrel rascal" * (k % 4 == 0)) for k in range(240)]
    df = spark.createDataFrame(table, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(240)], "doc_id long, toxic int")
    got = toxicity.cross_validated(df, labels, [(20, 0.5), (1000, 0.0)], folds=2).collect()
    learnt = [k for k in range(240) if zlib.crc32(str(k).encode()) % 3 != 1]
    for setting in ((20, 0.5), (1000, 0.0)):
        own = [x for x in got if (x.support, x.left_out) == setting]
        assert sorted(x.fold for x in own) == [0, 1]
        assert sum(x.hits + x.misses for x in own) == sum(k % 4 == 0 for k in learnt)
        assert sum(x.hits + x.misses + x.false_alarms + x.passes for x in own) == len(learnt)
        assert sum(x.hits for x in own) > 0.9 * sum(x.hits + x.misses for x in own)
    first = toxicity.best_setting(spark.createDataFrame([(5, 0.0, 0, 3, 0, 1, 9, 2.0), (9, 0.0, 0, 3, 0, 1, 9, 1.0), (7, 0.5, 0, 4, 4, 0, 5, 0.1)], "support long, left_out double, fold long, hits long, false_alarms long, misses long, passes long, loss double")).first()
    assert first.support == 9
    assert toxicity.cross_validated(nothing, labels, [(20, 0.5)]).count() == 0


def brute_groups(rows):
    def shingles(t):
        w = __import__("re").findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()

    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("tile", [512, 3])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(neardup, "TILE", tile)
    r = random.Random(9)
    texts = [None, "", "one", "One", "one two three four", "one two three four five"]
    for base in range(6):
        w = prose(70, 100 + base).split()
        for _ in range(12):
            v = list(w)
            for _ in range(r.randint(0, 5)):
                v[r.randrange(len(v))] = r.choice(WORDS) + "x"
            texts.append(" ".join(v))
    order = r.sample(range(len(texts)), len(texts))
    rows = [(i, texts[k]) for i, k in enumerate(order)]
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_groups(rows)


def test_links_are_those_of_the_words(spark, monkeypatch):
    long = thue_morse(1024, "a", "q")
    rows = [(k, t) for k, t in enumerate([*long, " ".join([long[0], *prose(40, 5).split()]), " ".join([long[1], *prose(40, 5).split()]), " ".join(long), " ".join(long[::-1])])]
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_groups(rows)
    r = random.Random(12)
    base = prose(90, 6).split()
    for tuples in (1 << 21, 0):
        monkeypatch.setattr(neardup, "TUPLES", tuples)
        for n in (0, 1, 4, 5, 90):
            for changes in (0, 1, 2, 3, 6):
                v = base[:n]
                for _ in range(changes if n else 0):
                    v[r.randrange(n)] = "other"
                a, b = " ".join(base[:n]), "  ".join(v).upper()
                assert neardup.exactly_linked(a.encode(), b.encode()) == (len({g for _, g in brute_groups([(1, a), (2, b)]).values()}) == 1 and n > 0), (n, changes)


@pytest.mark.parametrize("tile", [512, 3])
def test_words_that_shared_a_fixed_key(spark, monkeypatch, tile):
    monkeypatch.setattr(neardup, "TILE", tile)
    a, b = "abcdefghijklmno", "sfotvsbh+'t*wb5"  # equal under the mixing of words.mixed without a seed
    one, other = (np.frombuffer(x.encode(), np.uint8) for x in (a, b))
    plain, keyed = ([words.keys(x, np.array([0]), np.array([15]), seed)[0] for x in (one, other)] for seed in (0, 1 << 63 | 99))
    assert plain[0] == plain[1] and keyed[0] != keyed[1]
    base = prose(60, 77).split()
    texts = [" ".join(w if k % 3 else x for k, w in enumerate(base)) for x in (a, b)]
    near = [" ".join([*t.split()[:-1], "end"]) for t in texts]
    rows = list(enumerate([*texts, texts[0].upper(), *near, *texts[1].split()[:2]]))
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_groups(rows) and got[1][1] != got[0][1]


def test_equal_sets_of_different_words_are_linked(spark):
    rows = [(1, "a a a a a a"), (2, "a a a a a a a a"), (3, "A  a\ta\na a a"), (4, "b c d e f b c d e f b c d e f"), (5, "b c d e f b c d e f b c d e f b c d e f"), (6, "c d e f b c d e f b c d e f b")]
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_groups(rows)


def test_the_digest_of_words_knows_no_gaps(monkeypatch):
    r = random.Random(8)
    for size in (1, 5, 1 << 20):
        monkeypatch.setattr(words, "SLICE", size)
        for _ in range(50):
            w = [r.choice(["a", "B", "é", "ccc"]) for _ in range(r.randint(0, 9))]
            gap = lambda: r.choice([" ", "\n\t", "\v\f\r "])
            a, b = gap().join(w), gap() + "".join(x.replace("B", "b") + gap() for x in w)
            assert words.sequence_digest(a.encode()) == words.sequence_digest(b.encode())
            assert words.sequence_digest(a.encode()) != words.sequence_digest((a + "x").encode())


def test_a_hot_centre_is_dealt_in_blocks(spark):
    pairs = spark.createDataFrame([(k, 1) for k in range(2, 700)] + [(k, k - 1) for k in range(900, 950)], "x long, y long")
    got = neardup._dealt(pairs)
    rows = got.collect()
    assert sorted((r.node, r.y) for r in rows if r.role) == sorted(map(tuple, pairs.collect()))
    assert max(sum(r.block == b and r.role for r in rows) for b in {r.block for r in rows}) <= neardup.BLOCK
    assert {(r.y, r.block) for r in rows if r.role} == {(r.y, r.block) for r in rows if not r.role and r.node == r.y}


def test_near_duplicates_edges(docs, nothing):
    rows = neardup.near_duplicates(docs).collect()
    assert len(rows) == len(ROWS) and all(r.kept == (r.component_id == r.doc_id) for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[0].n_shingles == 0 and by[0].kept and by[6].component_id == 5 and by[7].component_id == 5
    assert neardup.near_duplicates(nothing).count() == 0


def test_near_duplicates_of_null_and_repeated_ids(spark):
    w = [prose(60, 900 + k).split() for k in range(4)]
    near = lambda k: " ".join([*w[k][:-1], "other"])
    text = lambda k: " ".join(w[k])
    rows = [(None, text(0)), (9, near(0)), (7, text(1)), (7, text(2)), (8, near(1)), (6, near(2)), (None, text(3)), (None, near(3)), (None, "")]
    got = neardup.grouped(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    by = {t: r for t, r in ((t, r) for i, t in rows for r in got if r.doc_id == i and r.key == spark.createDataFrame([(t,)], "t string").select(neardup.text_key(F.col("t"))).first()[0])}
    assert len(got) == len(rows) == len(by)
    assert by[text(0)].component_id == by[near(0)].component_id == 9 and not by[text(0)].kept
    assert by[text(1)].component_id == by[near(1)].component_id == 7 and by[text(1)].kept and not by[near(1)].kept
    assert by[text(2)].component_id == by[near(2)].component_id == 6 and not by[text(2)].kept
    assert by[text(1)].component != by[text(2)].component
    assert by[text(3)].component == by[near(3)].component is not None and by[text(3)].component_id is None


def test_bayes_limits_miss_less_than_asked():
    from math import comb

    for n, least in zip(range(16, 129, 16), neardup.least_matches(), strict=True):
        below = sum(comb(n + 1, m) * 0.75**m * 0.25 ** (n + 1 - m) for m in range(least))
        assert below < neardup.MISS


def test_components(spark):
    r = random.Random(6)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(400, 460)] + [(500, k) for k in range(501, 560)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    want = {x: find(x) for x in root if any(x in e and e[0] != e[1] for e in edges)}
    got = {x.node: x.component for x in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == want
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


#: Pages, and the lines that are not dropped.
WRAPPED = [
    ('<main><div class="layout has-sidebar"><article><h1>T</h1><p>Text.</p></article></div></main>', ["T", "Text."]),
    ('<div class="content-with-sidebar"><p>Text.</p></div>', ["Text."]),
    ('<div class="page ads-enabled"><div role="main"><p>Text here.</p></div></div>', ["Text here."]),
    ('<main><div class="sidebar-layout"><article><p>Text.</p></article></div></main>', ["Text."]),
    ('<article><p>One.</p><p class="related">Two.</p><h2 class="menu">Three</h2><p class="notice">Four.</p><blockquote class="social">Five.</blockquote></article>', ["One.", "Two.", "Three", "Four.", "Five."]),
    ('<article><p>One long text.</p><div class="ad-slot">Buy</div><div class="advertisement-300x250">Buy now</div><div class="newsletter-signup">Mail</div><p class="ad">Ad</p></article>', ["One long text."]),
    ('<div class="sidebar"><a href=x>link</a> stuff</div><div class="sidebar-page"><p>Most of the text is here, a lot of it.</p></div>', ["Most of the text is here, a lot of it."]),
    ('<div class="related"><p>a</p></div><article><p>real text</p></article><div class="related"><article>teaser</article></div>', ["real text"]),
    ('<div class="post"><p>Short.</p></div><div class="comments-area"><p>A reader goes on and on and on about it.</p><article class="comment">Me too, at length.</article></div>', ["Short."]),
    ('<div class="post comments-open"><p>The text of it.</p><div class="comment-list">hear, hear</div></div>', ["The text of it."]),
    ('<div class="related"><p>never closed<article><p>Text.</p></article>', ["Text."]),
]


@pytest.mark.parametrize(("page", "kept"), WRAPPED)
def test_no_name_drops_what_holds_the_article(page, kept):
    assert [t for t, kind in html_extract.lines(page)[0] if kind != html_extract.GONE] == kept
