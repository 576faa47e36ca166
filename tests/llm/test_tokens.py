import base64
import collections
import hashlib
import random
import zlib

import numpy as np
import pytest

from segstream.llm import bpe, packing, tokenfile
from segstream.llm.common import TOKENIZER_DIR
from segstream.llm.tokens import Encoder

ODD = ["", " a", "a ", "a  b", "it's 's x 's", "a \n b", "a\nb c", "x\u00a0y", "a b \x1cc", "日本 語", "\x00 a b", "e \u0301x", "İt İ. ΣΑΣ ΣΣ.", "<|endoftext|> a", "!!! a--- b%%%"]


def odd_texts(n, seed):
    rng = random.Random(seed)
    letters = " \n\t'sab1.é\u0301İΣ t日🙂ß%"
    return ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 30))) for _ in range(n)]


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_tokenizers_ids(file):
    e, texts = Encoder(file, max_pieces=500), odd_texts(3000, 2)
    for _ in range(2):  # the second time from kept pieces
        assert e.packed([*texts, None])[:-1] == e.encode(texts)


def tiktoken_like(file):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(f"{TOKENIZER_DIR}/{file}", "rb"))}
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_transducer_equals_tiktoken_and_round_trips():
    file = "byte_bpe_multi_50k.tiktoken"
    c, want = bpe.codec(file), tiktoken_like(file)
    texts = odd_texts(3000, 5) + ["a" * 3000, "ab" * 999, " " * 500, "\n" * 99, "aaab" * 77]
    for t in texts:
        ids = c.encode(t)
        assert ids.tolist() == want.encode_ordinary(t), t
        assert c.decode(ids) == t.encode()
    small = bpe.Transducer(c.vocabulary, max_states=3)  # starts afresh all the time
    for t in texts[:300]:
        assert [i for p in c.split(t) for i in small.encode(p.encode())] == c.encode(t).tolist()


def test_streaming_decoder_holds_back_unfinished_characters():
    c = bpe.codec("byte_bpe_multi_50k.tiktoken")
    text = "é日🙂 plain \U0001f9e9x"
    ids = np.array([c.vocabulary.ranks[bytes([b])] for b in text.encode()], "<u4")
    for step in (1, 2, 3, 5):
        d, out = c.decoder(), []
        for i in range(0, len(ids), step):
            part = d.feed(ids[i : i + step])
            part.decode()  # complete characters only
            out.append(part)
        assert b"".join(out) + d.end() == text.encode() and not d.broken
    d = c.decoder()
    d.feed(np.array([c.vocabulary.ranks[b"\xe6"], c.vocabulary.ranks[b"a"]], "<u4"))
    assert d.broken


def test_round_trip_query(docs, no_docs):
    want = tiktoken_like("byte_bpe_multi_50k.tiktoken")
    texts = collections.Counter((r["doc_id"], r["text"]) for r in docs.collect())
    seen = collections.Counter()
    expected = collections.Counter()
    for (i, t), n in texts.items():
        ids = want.encode_ordinary(t or "")
        expected[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += n
    for r in bpe.round_trip(docs).collect():
        seen[tuple(r)] += 1
    assert seen == expected
    assert bpe.round_trip(no_docs).collect() == []


def whole(file, text, end_id=2):
    e = Encoder(file)
    return np.append(np.frombuffer(e.encode([text or ""])[0], e.dtype), end_id).astype("<u4")


def test_token_files(docs, no_docs, tmp_path):
    rows = tokenfile.token_digests(docs).orderBy("start").collect()
    source = docs.collect()
    assert len(rows) == len(source)
    ids = [r["doc_id"] for r in rows]
    assert [i is None for i in ids] == sorted([i is None for i in ids], reverse=True)
    assert [i for i in ids if i is not None] == sorted(i for i in ids if i is not None)
    start = 0
    for r in rows:
        assert r["start"] == start
        start += r["n_tokens"]
    want = collections.Counter((r["doc_id"], len(x), zlib.crc32(x.tobytes())) for r in source for x in [whole("byte_bpe_50k.json", r["text"])])
    assert want == collections.Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows)
    assert tokenfile.token_digests(no_docs).collect() == []


def test_token_file_random_access(tmp_path):
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 60000, n).astype("<u2") for n in (5, 300, 1, 77, 4000, 9)]
    uri = f"file://{tmp_path}/x/a.arrow"
    w = tokenfile.SequenceWriter(uri, np.dtype("<u2"), length=64, batch_rows=4)
    w.add([1, None, 3], texts[:3])
    w.add([4, 5, 6], texts[3:])
    total = w.close()
    flat = np.concatenate(texts)
    assert total == len(flat)
    f = tokenfile.SequenceFile(uri, batch_rows=4)
    for i in reversed(range(-(-total // 64))):
        ids, mask = f.sequence(i)
        real = flat[i * 64 : i * 64 + 64]
        assert ids[: len(real)].tolist() == real.tolist() and mask.to_pylist() == [k < len(real) for k in range(64)]
        assert not ids.flags.owndata  # a view of the mapped file
    assert [d for d, _, _ in f.documents()] == [1, None, 3, 4, 5, 6]
    assert all((a == b).all() for (_, _, a), b in zip(f.documents(), texts))


@pytest.mark.parametrize("pool", [1, 1 << 20])
def test_packing(docs, no_docs, pool):
    rows = packing.pack_documents(docs, pool_tokens=pool).collect()
    by_sequence, by_doc = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"], r["doc_tokens"]].append((r["start"], r["length"], r["ids_crc32"]))
    padded = 0
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 4096
        padded += 0 if at & (at - 1) == 0 else 4096 - at
    total = sum(r["length"] for r in rows)
    want, spans = collections.Counter(), collections.Counter()
    for r in docs.collect():
        ids = whole("word_bpe_49k.json", r["text"])
        want[r["doc_id"], len(ids)] += len(ids)
    for key, parts in by_doc.items():
        spans[key] = sum(p[1] for p in parts)
    assert spans == want and total == sum(want.values())
    assert padded <= 4096 * docs.rdd.getNumPartitions()
    ids = whole("word_bpe_49k.json", next(r["text"] for r in docs.collect() if r["doc_id"] == 6))
    at = 0
    for start, length, crc in sorted(by_doc[6, len(ids)]):
        assert start == at and crc == zlib.crc32(ids[start : start + length].tobytes())
        at += length
    groups = collections.defaultdict(int)
    for r in rows:
        groups[r["step_group"], r["tier"]] += r["length"]
    assert max(groups.values()) <= 1 << 15
    assert packing.pack_documents(no_docs).collect() == []


def test_ascii_words_are_read_as_they_stand(monkeypatch):
    """Letters of ASCII need no byte table; ids equal the tokenizer's own."""
    from segstream.llm import tokens

    text = "plain Words with-marks, (x) Don't stop!!! café naïve 12 a1 \x1cz ZZtop q."
    for file in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        e = tokens.Encoder(file)
        ids = e.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(e.packed([text])[0], e.dtype).tolist() == ids
        monkeypatch.setattr(tokens, "LAST_LATIN", "")
        assert e.word("Words") == ("Words" if e.keep_space else "words") and e.word("é") is None
        monkeypatch.undo()
    assert tokens.Encoder("byte_bpe_50k.json").word(" word") == "Ġword"
