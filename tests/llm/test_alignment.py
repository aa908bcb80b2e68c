import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import alignment

A, B = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def plain(texts):
    """The contract's results, token by token, from the tokenizers themselves."""
    a_model = Tokenizer.from_file(A)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=B)
    symbols = alignment.byte_symbols()
    rows, seen = [], Counter()
    for t in texts:
        raw = (" " + (t or "")).encode()
        a = a_model.encode(" " + t, add_special_tokens=False).ids if t else []
        b = b_model.encode(t) if t else []
        ab = [bytes(symbols[c] for c in a_model.id_to_token(i)) for i in a]
        bb = [bytes([int(p[3:5], 16)]) if b_model.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b_model.id_to_piece(i)) for i in b)]
        if b"".join(ab) != raw or b"".join(bb) != raw or not t:
            rows.append((0, 0, [], Counter()))
            continue
        groups, i, j = [], 0, 0
        while i < len(a):
            ga, gb, na, nb = [a[i]], [b[j]], len(ab[i]), len(bb[j])
            i, j = i + 1, j + 1
            while na != nb:
                if na < nb:
                    ga.append(a[i])
                    na += len(ab[i])
                    i += 1
                else:
                    gb.append(b[j])
                    nb += len(bb[j])
                    j += 1
            groups.append((ga, gb))
        links = Counter((x, y) for ga, gb in groups for x in ga for y in gb)
        seen.update(set(links))
        rows.append((len(a), len(b), groups, links))
    best = defaultdict(int)
    for (x, _), n in seen.items():
        best[x] = max(best[x], n)
    out = []
    for n_a, n_b, groups, links in rows:
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        won = sum(k for p, k in links.items() if seen[p] == best[p[0]])
        out.append((n_a, n_b, len(groups), sum(links.values()), won, sum(k * seen[p] for p, k in links.items()), digest))
    return out


TEXTS = [
    None,
    "",
    "the quick brown fox",
    "the quick brown fox",
    "  two  spaces \t\n\n and \x00 nul",
    "<|endoftext|> <s> </s> <unk> <0x41>",
    "▁ a piece mark",
    "日本語のテキスト と 한국어 👩‍👩‍👧 naïve é́ ﷽",
    "a" * 5000 + " " * 5000 + "b",
    "\r\n" * 300 + "x1234567890" * 50,
    " ".join(f"word{i % 700} of the" for i in range(4000)),
    "Größe l'été n't 'll 3.14159 #*$%&|<>",
]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


@pytest.mark.parametrize("sent", [alignment.SENT, 300, 0])
def test_equals_the_plain_version(spark, sent):
    df = frame(spark, TEXTS).withColumn("pairs", F.lit("mine")).withColumn("n_a", F.lit("mine")).repartition(3)
    got = {r["doc_id"]: tuple(r)[1:] for r in alignment.align(df, A, B, sent=sent).collect()}
    want = plain(TEXTS)
    for i, (n_a, n_b, n_groups, n_links, won, sums, digest) in enumerate(want):
        assert got[i] == (n_a, n_b, n_groups, n_links, won, sums, digest), (i, TEXTS[i])


def test_equals_the_plain_version_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id")
    texts = [r["text"] for r in docs.collect()]
    df = frame(spark, texts)
    got = {r["doc_id"]: tuple(r)[1:] for r in alignment.align(df, A, B).collect()}
    assert [got[i] for i in range(len(texts))] == plain(texts)


def test_a_large_group_is_listed_by_distinct_ids(monkeypatch):
    al = alignment.Aligner(A, B)
    raws = [t and t.encode() for t in TEXTS]
    want = [tuple(map(lambda x: x.tolist() if hasattr(x, "tolist") else x, r)) for r in al.slice(raws)]
    monkeypatch.setattr(alignment, "LARGE", 1)
    assert [tuple(map(lambda x: x.tolist() if hasattr(x, "tolist") else x, r)) for r in al.slice(raws)] == want


def test_invalid_bytes_ids_and_empty_tables(spark, docs, no_docs):
    bad = spark.createDataFrame([(1, bytearray(b"ab\xffcd"))], "doc_id long, text binary")
    assert tuple(alignment.align(bad, A, B).first()) == (1, 0, 0, 0, 0, 0, 0, "")
    got = alignment.align(docs, A, B).collect()
    assert len(got) == docs.count() and len({r["groups_sha256"] for r in got if r["doc_id"] in (1, 2)}) == 1
    assert alignment.align(no_docs, A, B).collect() == []


def test_both_byte_level_encoders_agree_on_every_character():
    enc = alignment.ByteLevel(A)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(points), 4000):
        texts = [f" a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}9 .{chr(c)}\n" for c in points[k : k + 4000 : 1 if k < 0x4000 else 40]]
        want = [e.ids for e in enc.own.encode_batch(texts, add_special_tokens=False)]
        assert [enc.fast.encode_ordinary(t) for t in texts] == want
