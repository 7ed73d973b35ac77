"""Packing, token counts, piece encoding and chat formatting against the libraries and exact round trips."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from entityspark.llm import chat, packing, token_counts
from entityspark.llm import sentence_pieces as SP

ODD = [None, "", " ", "\n\n", "a", "Ünïcödé ñ ß", "日本語 text", "don't stop 's", "x" * 5000, "word " * 6000, "<|endoftext|> inside", "tab\there\u00a0nbsp\u200bzero", "e\u0301 combining", "½ ² ¹", "a\x1cb \x85 c", "İstanbul ΑΣ"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(4, "a", "x"), (None, "no id", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)


def test_counts_equal_library(spark, docs):
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = [tuple(r) for r in token_counts.count_tokens(docs, P.path("byte_bpe_50k.json")).collect()]
    want = []
    for r in docs.collect():
        n = len(tok.encode(r.text or "", add_special_tokens=False).ids)
        want.append((r.doc_id, len((r.text or "").encode()), n, n > 512))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert token_counts.count_tokens(docs.limit(0), P.path("byte_bpe_50k.json")).count() == 0


def test_character_classes_agree_with_library():
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    enc = packing.WordEncoder(P.path("word_bpe_49k.json"))
    import regex

    find = regex.compile(token_counts.PRETOKEN).findall
    for i in range(0x3000):
        ch = chr(i)
        text = f"a{ch}b {ch}{ch} 1{ch}2 {ch} "
        if not token_counts._OTHER.search(text):
            assert "".join(find(text)) == text
            assert sum(len(tok.encode(p, add_special_tokens=False).ids) for p in find(text)) == len(tok.encode(text, add_special_tokens=False).ids), hex(i)
        if not packing._OTHER.search(text):
            assert enc.encode(text) == np.array(enc.tok.encode(text, add_special_tokens=False).ids, enc.dtype).tobytes(), hex(i)


def check_packing(rows, want, window):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for seq in by_seq.values():
        at = 0
        for r in sorted(seq, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == window or at & (at - 1) == 0 and at < window
    got = sorted(b"".join(bytes(r.ids) for r in sorted(rs, key=lambda r: r.start)) for d, rs in by_doc.items() if len([x for x in want if x[0] == d]) == 1)
    assert got == sorted(ids for d, ids in want if len([x for x in want if x[0] == d]) == 1)
    assert sum(r.length for r in rows) == sum(len(ids) // 4 for _, ids in want)


def test_packing_holds_every_id_once(spark, docs):
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    for window, index in ((64, 300), (2048, 1 << 18)):
        rows = packing.pack_documents(docs, P.path("word_bpe_49k.json"), window=window, task_tokens=4 * index, index_tokens=index).collect()
        want = [(r.doc_id, np.array([*tok.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()) for r in docs.collect()]
        check_packing(rows, want, window)
    assert packing.pack_documents(docs.limit(0), P.path("word_bpe_49k.json")).count() == 0


def test_neighbours_are_bm25_best():
    rng = np.random.default_rng(5)
    items = [rng.integers(0, 60, rng.integers(1, 40)).astype("<u2") for _ in range(50)]
    n, avg = len(items) + 7, np.mean([len(x) for x in items]) + 1  # statistics of a larger corpus
    df = np.array([sum(t in x for x in items) + t % 3 for t in range(60)], float)
    index = packing.Index([x.tobytes() for x in items], "<u2", packing.Statistics(n, avg * n, df))

    def score(q, d):
        total = 0.0
        for t in set(items[q].tolist()):
            if tf := int((items[d] == t).sum()):
                total += max(0, np.log((n - df[t] + 0.5) / (df[t] + 0.5))) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(items[d]) / avg))
        return total

    for q in range(10):
        unused = np.ones(n - 7, bool)
        unused[[q, 3, 7]] = False
        want = sorted((d for d in range(n - 7) if unused[d] and score(q, d) > 0), key=lambda d: (-round(score(q, d), 4), d))
        assert index.neighbours(q, unused).tolist()[:5] == want[:5]


def test_statistics_and_keys_cover_all_pieces(spark):
    """Copies dealt over many partitions come to stand side by side."""
    rng = np.random.default_rng(2)
    texts = [" ".join(f"{chr(97 + a)}{chr(97 + b)}x" for a, b in rng.integers(0, 26, (30, 2))) for _ in range(60)]
    d = spark.createDataFrame([(i, texts[i % 60]) for i in range(120)], "doc_id long, text string").repartition(7)
    enc = packing.word_encoder(P.path("word_bpe_49k.json"))
    cut = packing.token_pieces(d, P.path("word_bpe_49k.json"), 2048, 1)
    stats = packing.statistics(cut, enc.dtype, enc.tok.get_vocab_size())
    sets = [set(np.frombuffer(enc.encode(texts[i % 60]), enc.dtype).tolist()) | {1} for i in range(120)]
    want = Counter(t for s in sets for t in s)
    assert stats.n == 120 and {int(t): int(stats.df[t]) for t in np.flatnonzero(stats.df)} == dict(want)
    rows = packing.pack_documents(d, P.path("word_bpe_49k.json"), window=256, task_tokens=2000, index_tokens=1000).collect()
    seqs = {}
    for r in rows:
        seqs.setdefault(r.doc_id % 60, []).append(r.sequence_id)
    assert sum(len(set(s)) < len(s) for s in seqs.values()) > 40


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 63), min_size=1, max_size=40))
def test_pack_shard_never_pads(sizes):
    stats = packing.Statistics(2 * len(sizes), sum(sizes), np.ones(64))
    plan = packing.pack_shard(sizes, packing.Index([np.arange(n, dtype="<u2").tobytes() for n in sizes], "<u2", stats), 64)
    total = {}
    for item, a, n, seq, off in plan:
        total[seq] = total.get(seq, 0) + n
    assert sum(total.values()) == sum(sizes) and all(t == 64 or t & (t - 1) == 0 for t in total.values())
    for i, n in enumerate(sizes):
        assert [x for p in sorted(p for p in plan if p[0] == i) for x in range(p[1], p[1] + p[2])] == list(range(n))


@pytest.fixture(scope="module")
def pieces():
    return SP.Pieces(P.path("piece_bpe_32k.model"))


def test_chunks_give_the_whole_texts_path(pieces):
    random.seed(3)
    parts = ["the ", "and", "  ", " ", "   ", "x" * 30, "é", "日", "\n", "ing", "aaaa", "=========", "\U0001F600", "\u0e01"]
    for _ in range(60):
        t = "".join(random.choice(parts) for _ in range(random.randint(1, 50)))
        full = SP.MARK + t.replace(" ", SP.MARK)
        want = pieces.best(full, 0, len(full), len(full), 0) if pieces.parted is False else (0, pieces.whole(full))
        size, prep = random.randint(3, 40), []
        for c, a in enumerate(range(0, len(t), size)):
            body = (SP.MARK if c == 0 else "") + t[a:a + size].replace(" ", SP.MARK)
            prep.append((body + t[a + size:a + size + pieces.longest].replace(" ", SP.MARK), len(body), pieces.since(full, a + 1) if a else 0))
        s = SP.boundary_states(np.stack([pieces.transfer(*x) for x in prep]))
        got = b"".join(pieces.path(x, b, s[c], s[c + 1], q) for c, (x, b, q) in enumerate(prep))
        assert got == want[1] and pieces.decode(np.frombuffer(got, "<u4"), True) == t


def test_path_is_the_best_one(pieces):
    """Against all segmentations of short strings."""
    def every(s, at=0):
        if at == len(s):
            yield 0
            return
        for to, w, _ in pieces.arcs(s, at, len(s), 0):
            for rest in every(s, to):
                yield w + rest

    for s in ("▁thing", "▁hello", "▁▁▁a", "▁e\u0e01in"):
        assert pieces.forward(s, 0, len(s), len(s), 0)[0][-1] == max(every(s))


def test_encode_decode_rows(spark, docs):
    d = docs.unionByName(spark.createDataFrame([(100, "giant text of words " * 200 + "y" * 900 + " end", "x")], docs.schema))
    out = SP.decode_pieces(SP.encode_pieces(d, P.path("piece_bpe_32k.model"), chunk_chars=256), P.path("piece_bpe_32k.model")).collect()
    texts = {}
    for r in sorted(out, key=lambda r: (r.row_id, r.chunk)):
        assert r.decoded == r.text
        texts[r.row_id] = texts.get(r.row_id, "") + r.text
    assert sorted(texts.values()) == sorted((r.text or "") for r in d.collect())


def test_piece_ids_are_the_librarys(spark, docs):
    import sentencepiece

    path = P.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    more = ["giant text of  words " * 200 + "y" * 900 + " \u0e01end  ", "a ▁ b▁c ▁", "   ", " internationalization of tokenizers\nand  such "]
    d = docs.unionByName(spark.createDataFrame([(200 + i, t, "x") for i, t in enumerate(more)], docs.schema))
    out = SP.encode_pieces(d, path, chunk_chars=256).collect()
    texts, ids, parts = {}, {}, 0
    for r in sorted(out, key=lambda r: (r.row_id, r.chunk)):
        texts[r.row_id] = texts.get(r.row_id, "") + r.text
        ids[r.row_id] = ids.get(r.row_id, b"") + bytes(r.ids)
        parts = max(parts, r.chunk)
    assert parts > 5 and sorted(texts.values()) == sorted((r.text or "") for r in d.collect())
    for row, text in texts.items():
        assert np.frombuffer(ids[row], "<u4").tolist() == sp.encode(text), text[:50]


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="\\<l|im_start>end\nn ab"))
def test_escape_round_trip(text):
    e = chat.escape(text)
    assert chat.unescape(e) == text and "<" not in e
    assert chat.unescape(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)


def test_chat_digests(spark):
    rows = [(1, 0, "user", "hi <|im_end|>"), (1, 1, "assistant", None), (1, 300, "assistant", "a\\lb"), (2, 1, None, "x"), (2, 1, "assistant", "tie"), (2, None, "system", "first"), (3, 0, "assistant", "<|im_end|><|im_start|>assistant ok")]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    got = {r.conv_id: r for r in chat.conversation_digests(chat.turns(d)).collect()}
    for c in (1, 2, 3):
        mine = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", chat.escape(r[3] or "")))
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine)
        learned = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == (len(mine), hashlib.sha256(turns.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert chat.conversation_digests(chat.turns(d.limit(0))).count() == 0


def test_typed_parts(spark):
    parts = "array<struct<type:string,text:string,ref:string,tokens:int,pages:int>>"
    rows = [(1, 0, "user", [("text", "look <", None, None, None), ("image", None, "a.png", None, None), ("document", None, "b.pdf", None, 3), ("audio", None, "c.wav", 12, None), ("video", None, "d", None, None)]), (1, 1, "user", None)]
    r = chat.turns(spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {parts}"), "parts").orderBy("turn").collect()
    assert "look \\l<|image_0_0|><|document_0_1|><|audio_0_2|>" in r[0].formatted and [a.ref for a in r[0].attachments] == ["a.png", "b.pdf", "c.wav"]
    assert r[0].expanded_tokens == 576 + 3 * 1024 + 12 and r[1].formatted.endswith("\n<|im_end|>\n")


def test_typed_parts_read_back():
    parts = [{"type": "text", "text": "a <|image_3_0|> \\l"}, {"type": "image", "ref": "x.png", "tokens": 5}, {"type": "audio", "ref": "y.wav", "tokens": 7}, {"type": "text", "text": "<|im_end|>"}]
    body, found = chat.flatten_parts(parts, 3)
    assert chat.read_parts(body, found) == parts and body.count("<|image_3_0|>") == 1
    other, _ = chat.flatten_parts(parts, 4)
    assert not set(chat._PLACEHOLDER.findall(body)) & set(chat._PLACEHOLDER.findall(other))
