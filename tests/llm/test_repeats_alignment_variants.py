"""Repeated passages, tokenizer alignment and spelling variants against brute force, with edge rows."""
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from riskspark.llm import alignment, bwtmerge, variants
from riskspark.llm.bpe import byte_alphabet
from riskspark.llm.queries import PIECES, VOCABULARY

SCHEMA = "doc_id long, text string, pack long, kind int, word string, bytes binary"
PASSAGE = "This passage of more than fifty bytes stands in several documents, é and all. "


def texts():
    rng = random.Random(5)
    some = ["".join(rng.choices("abcd ", k=rng.randint(0, 160))) for _ in range(60)]
    out = [(i, (PASSAGE if i % 3 == 0 else "") + t + (PASSAGE[20:] if i % 4 == 0 else "")) for i, t in enumerate(some)]
    out += [(100, None), (101, ""), (102, out[3][1]), (103, "z" * 3000), (104, "z" * 700), (7, PASSAGE * 2), (7, PASSAGE * 2),
            (None, PASSAGE + "without an id"), (None, PASSAGE), (105, "x" * 49), (106, "".join(rng.choices("abcdefgh \n", k=120_000)))]
    rng.shuffle(out)
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "w", b"b") for i, t in rows], SCHEMA)


def removed(rows):
    first: dict = {}
    ids = [bwtmerge.LARGEST if i is None else i for i, _ in rows]
    raw = [(t or "").encode() for _, t in rows]
    for i, b in zip(ids, raw, strict=True):
        for p in range(len(b) - 49):
            first[b[p:p + 50]] = min(first.get(b[p:p + 50], i), i)
    for (own, _), i, b in zip(rows, ids, raw, strict=True):
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] < i:
                gone[p:p + 50] = b"\1" * 50
        runs = [m.span() for m in re.finditer(b"\1+", bytes(gone))]
        yield own, len(b), [a for a, _ in runs], [e for _, e in runs], bytes(x for x, g in zip(b, gone, strict=True) if not g)


def in_order(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("crowded", [bwtmerge.CROWDED, 2])
def test_repeats_equal_brute_force(spark, crowded):
    rows = texts()
    got = [(r.doc_id, r.n_bytes, r.starts, r.ends, bytes(r.kept))
           for r in bwtmerge.without_repeats(frame(spark, rows).repartition(5), crowded=crowded).collect()]
    assert in_order(got) == in_order(removed(rows))


def test_merge_finds_common_prefixes():
    """Rows in the merged order are the sorted suffixes, and reach is the longest common prefix."""
    rng = random.Random(3)
    shards = [["".join(rng.choices("ab", k=rng.randint(50, 90))).encode() for _ in range(n)] for n in (3, 1, 4)]
    lines = []
    for strings in shards:
        buf, length = np.frombuffer(b"".join(strings), np.uint8), np.array([len(s) for s in strings])
        lines.append(bwtmerge.transform(buf, np.cumsum(length) - length, length, np.zeros(len(strings), np.int64))[0])
    merged = bwtmerge.Merged(lines, depth=12)
    flat = [s for strings in shards for s in strings]
    string, length = merged.places()
    suffix = [flat[s][len(flat[s]) - n:] for s, n in zip(string, length, strict=True)]
    for k, own in enumerate(suffix):
        common = max(len(own) if other[:len(own)] == own else next(
            (i for i, (x, y) in enumerate(zip(own, other, strict=False)) if x != y), min(len(own), len(other)))
            for j, other in enumerate(suffix) if j != k)
        assert merged.reach[k] == min(common, 12)
    prefixes = [suffix[r][:12] for r in merged.rows]
    assert prefixes == sorted(prefixes)
    assert len(merged.blocks) == len(set(prefixes))


def aligned(rows):
    a_model = Tokenizer.from_file(VOCABULARY)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    back = {c: bytes([b]) for b, c in enumerate(byte_alphabet())}
    held, made = Counter(), []
    for i, text in rows:
        a = a_model.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_model.encode(text) if text else []
        bytes_a = [b"".join(back[c] for c in a_model.id_to_token(k)) for k in a]
        bytes_b = [bytes([int(b_model.id_to_piece(k)[3:5], 16)]) if b_model.is_byte(k)
                   else b_model.id_to_piece(k).replace("▁", " ").encode() for k in b]
        whole = b" " + (text or "").encode()
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            a = b = []
        at = [[sum(map(len, x[:k])) for k in range(len(ids) + 1)] for ids, x in ((a, bytes_a), (b, bytes_b))]
        links = Counter((x, y) for k, x in enumerate(a) for m, y in enumerate(b)
                        if at[0][k] < at[1][m + 1] and at[1][m] < at[0][k + 1])
        cuts = sorted(set(at[0][1:]) & set(at[1][1:]))
        parts = ["|".join(",".join(str(x) for k, x in enumerate(ids) if lo < pos[k + 1] <= hi) for ids, pos in ((a, at[0]), (b, at[1])))
                 for lo, hi in zip([0, *cuts], cuts, strict=False)]
        held.update(links.keys())
        made.append((i, len(a), len(b), len(cuts), links, ";".join(parts)))
    most: dict = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    for i, n_a, n_b, n, links, parts in made:
        yield (i, n_a, n_b, n, sum(links.values()), sum(m for p, m in links.items() if held[p] == most[p[0]]),
               sum(m * held[p] for p, m in links.items()), hashlib.sha256(parts.encode()).hexdigest() if parts else "", parts)


def test_alignment_equals_brute_force(spark):
    rows = [(1, "The quick brown fox, naïve façade — 日本語 😀 zażółć"), (2, "The quick brown fox"), (2, "The quick brown fox"),
            (3, None), (4, ""), (5, "  two spaces  and\ttabs\n\nlines "), (None, "no id <|endoftext|> <s>"), (6, "x\0y ▁ z"),
            (7, "supercalifragilistic " * 20), (8, "́á"), (9, "unbelievably 12345678 foxes")]
    want = list(aligned(rows))
    docs = frame(spark, rows).repartition(3)
    got = [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)
           for r in alignment.align(docs, VOCABULARY, PIECES).collect()]
    assert in_order(got) == in_order(w[:-1] for w in want)
    groups = [(r.doc_id, r.groups) for r in alignment.grouped(docs, VOCABULARY, PIECES).collect()]
    assert in_order(groups) == in_order((w[0], w[-1]) for w in want)


def test_alignment_models_spell_as_their_files_do():
    """The fast encoder gives the ids of the file's own library."""
    own = Tokenizer.from_file(VOCABULARY)
    own.encode_special_tokens = True
    pair, rng = alignment.loaded(VOCABULARY, PIECES), random.Random(1)
    pool = [chr(c) for c in (*range(0x250), *range(0x2000, 0x2070), 0x301, 0x3000, 0x4E2D, 0x1F600)] + ["'s", "  ", "<|endoftext|>"]
    for _ in range(2000):
        text = "".join(rng.choices(pool, k=rng.randint(1, 30)))
        assert pair.a_model.encode_ordinary(text) == own.encode(text, add_special_tokens=False).ids


def spelled(rows):
    count: Counter = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(str.maketrans(variants.CAPITALS, variants.SMALL))
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += len(run) >= 6
    count = Counter({w: n for w, n in count.items() if n >= 5})
    near = {w: [v for v in count if variants.one_edit(w, v)] for w in count}
    form = {}
    for w in count:
        best = min(near[w], key=lambda v: (-count[v], v), default=None)
        form[w] = best if best and count[best] >= 5 * count[w] else None
    for w in count:
        root = w
        while form[root]:
            root = form[root]
        yield w, form[w], root, count[w], len(near[w]), count[form[w]] if form[w] else None


def test_variants_equal_brute_force(spark):
    rng = random.Random(2)
    stems = ["chateau", "Königin", "banana", "receive", "colour", "aaaaaa", "straße", "l" * 50, "abcdef"]
    words = [w for w in stems for _ in range(rng.choice((5, 30, 200)))]
    for w in stems:
        for _ in range(12):
            k, c = rng.randrange(len(w)), rng.choice("aeéxñ")
            other = rng.choice((w[:k] + w[k + 1:], w[:k] + c + w[k:], w[:k] + c + w[k + 1:]))
            words += [other] * rng.choice((4, 5, 7, 40))
    rng.shuffle(words)
    rows = [(i, " ".join(words[i::40])) for i in range(40)] + [(50, None), (51, ""), (None, "banana bananna " * 9), (3, "one short"), (3, "BANANA 7")]
    rows += [(70, "planet " * 200 + "plannet " * 30 + "plannets " * 5)]  # a chain of forms
    rows += [(i, "q" * 9000 + " " + "q" * 9001) for i in range(60, 66)]
    want = in_order(spelled(rows))
    for spread in (4, 2):
        got = [tuple(r) for r in variants.variants(frame(spark, rows), spread=spread).collect()]
        assert in_order(got) == want
    assert any(w[1] and w[2] != w[1] for w in want) and any(w[5] is None and w[4] for w in want)


def test_one_edit():
    assert variants.one_edit("abc", "abcd") and variants.one_edit("abc", "bc") and variants.one_edit("abc", "xbc")
    assert not variants.one_edit("abc", "abc") and not variants.one_edit("abc", "acb") and not variants.one_edit("abc", "abcde")


def test_empty_tables(spark):
    docs = frame(spark, [])
    assert bwtmerge.without_repeats(docs).count() == 0
    assert alignment.align(docs, VOCABULARY, PIECES).count() == 0
    assert variants.variants(docs).count() == 0
    assert variants.variants(frame(spark, [(1, None), (2, "12 34")])).count() == 0
