"""Operators of the training-data pipeline: edge rows and brute-force comparisons."""
import hashlib
import re
import uuid
from collections import Counter
from fractions import Fraction

import pytest
from tokenizers import Tokenizer

from riskspark.llm import bpe, chat, imatch, langid, pfair, probminhash, quality, secrets, toxicity, warc
from riskspark.llm.queries import OP9_SQL, VOCABULARY

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, key string, node string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lam mu nu xi omicron pi rho sigma tau ups".split()
LONG = " ".join(f"{w}{i}" for i in range(300) for w in WORDS)
NEAR = LONG.replace("alpha7 ", "changed ")
ROWS = [(1, LONG, "en", "a"), (2, NEAR, "en", "a"), (3, None, "en", None), (4, "", None, "b"), (5, LONG, "en", "a"),
        (6, "token = \"0123456789abcdef0123456789abcdef01234567\" x", "en", "b"), (7, "x", "de", "b"),
        (7, "x", "de", "b"), (None, "no id here", "en", "c"), (8, "a  b\n\n c <|endoftext|> é", "fr", "c")]


@pytest.fixture()
def docs(spark):
    """Nulls, an empty and a long text, copies, repeated rows and columns with clashing names."""
    return spark.createDataFrame([(*r, len(r[1] or ""), 0.5, "k", "n") for r in ROWS], SCHEMA)


def test_bpe_equals_the_library(docs):
    reference = Tokenizer.from_file(VOCABULARY)
    got = sorted((str(r.doc_id), r.ids, r.decoded) for r in bpe.encode_decode(docs, VOCABULARY).collect())
    want = []
    for i, t, *_ in ROWS:
        ids = reference.encode(t or "", add_special_tokens=False).ids
        want.append((str(i), ids, reference.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want)


def test_secrets_and_redaction(docs):
    models = secrets.fit(docs)
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secrets.scan(docs, models).collect()}
    assert found[6] == [("assign", 0, 49), ("hex", 9, 49)]
    assert found[3] == [] and found[4] == []
    clean = {r.doc_id: r.text for r in secrets.redacted(docs, models).collect()}
    assert "0123456789abcdef" not in clean[6] and clean[1] == LONG and clean[3] is None


def test_failing_match_uses_up_its_text():
    assert secrets.rule_spans("password: secret: abcdefghijk") == []
    assert secrets.rule_spans("AKIA" + "B" * 11) == []
    assert [x[:2] for x in secrets.rule_spans("AKIA" + "B" * 12)] == [(0, 1)]


def test_toxicity_without_labels_scores_every_row(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    scores = [r.score for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()]
    assert len(scores) == len(ROWS) and all(abs(s - 0.01) < 1e-9 for s in scores)


def test_near_classes(docs):
    got = sorted((str(r.doc_id), str(r.class_id)) for r in probminhash.near_classes(docs).collect())
    assert got == sorted([("1", "1"), ("2", "1"), ("5", "1"), ("3", "3"), ("4", "4"), ("6", "6"), ("7", "7"), ("7", "7"),
                          ("None", "None"), ("8", "8")])
    kept = probminhash.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "6", "7", "8", "None"]


def test_one_period_deviates_less_than_a_block():
    share = pfair.in_period({"a": 0.5, "b": 0.3, "c": 0.19, "d": 0.01}, 97)
    seen, total = Counter(), sum(share.values())
    for t, (s, place, slot, release, deadline) in enumerate(pfair.one_period(share)):
        assert slot == t and release <= slot < deadline and place == seen[s]
        seen[s] += 1
        assert all(abs(seen[x] - share[x] * (t + 1) / total) < 1 for x in share)


def test_schedule_follows_its_target_weights(spark):
    """Against the targets themselves, with 1,200 sources of which one has a third, over the whole first phase."""
    target = {"hot": Fraction(1, 3), **{f"s{k}": Fraction(2, 3 * 1199) for k in range(1199)}}
    docs = spark.createDataFrame([(k, f"{k:010d}", "hot") for k in range(2000)] + [
        (10_000 + 4 * k + n, f"{4 * k + n:010d}", f"s{k}") for k in range(1199) for n in range(4)],
        "doc_id long, text string, source string")
    got = sorted((r.slot, r.source, r.block, r.release, r.deadline, r.phase)
                 for r in pfair.schedule(docs, target, block_chars=10).collect())
    assert [r[0] for r in got] == list(range(2000 + 4 * 1199))
    first = [r for r in got if r[5] == 0]
    assert len(first) == 6000
    seen = Counter()
    for slot, s, block, release, deadline, _ in first:
        w = target[s]
        assert block == seen[s] and (release, deadline) == (block // w, -(-(block + 1) // w))
        assert w * slot - seen[s] < 1
        seen[s] += 1
        assert seen[s] - w * (slot + 1) < 1
    assert all(abs(seen[s] - 6000 * w) < 1 for s, w in target.items())


def test_float_weights_over_many_slots():
    """A third of the characters in one of 20 sources, tempered: less than a block off after every slot."""
    weights = pfair.tempered({"hot": 10 ** 10, **{f"s{k}": 2 * 10 ** 10 // 19 for k in range(19)}})
    total = sum(Fraction(w) for w in weights.values())
    seen, number = Counter(), 0
    for s, block, phase, slot, release, deadline in pfair.timetable([(dict.fromkeys(weights, 3000), weights)]):
        if phase == 0:
            w = Fraction(weights[s]) / total
            assert slot == number and block == seen[s] and release <= slot < deadline
            assert w * slot - block < 1 and block + 1 - w * (slot + 1) < 1
        seen[s] += 1
        number += 1
    assert seen == Counter(dict.fromkeys(weights, 3000))


def test_many_sources_give_a_row_a_block():
    """1,500 sources that end one by one: rows are as many as blocks, not sources times phases."""
    blocks = {f"s{k}": 1 + k % 40 for k in range(1500)}
    rows = list(pfair.timetable([(blocks, dict.fromkeys(blocks, 1.0))]))
    assert [r[3] for r in rows] == list(range(sum(blocks.values())))
    assert Counter(r[0] for r in rows) == Counter(blocks) and rows[-1][2] == 39


def test_schedule_keeps_every_row(docs):
    assert pfair.schedule(docs, block_chars=1000).count() == len(ROWS)
    mixed = pfair.mixed(docs)
    assert mixed.columns == docs.columns and mixed.count() == len(ROWS)


def test_quality_counts(docs):
    got = {str(r.doc_id): r for r in quality.judge(docs).collect()}
    for i, t, *_ in ROWS:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        windows = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
        again = {k + j for k in range(len(w) - 2) if windows[tuple(w[k:k + 3])] > 1 for j in range(3)}
        assert (got[str(i)].n_words, got[str(i)].word_chars, got[str(i)].n_repeat_words) == (
            len(w), sum(map(len, w)), len(again))


def test_fingerprints(docs):
    got = [r for r in imatch.fingerprints(docs, least_share=0.1, most_share=0.9).collect()]
    assert len(got) == len(ROWS)
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest()))
    want = Counter()
    for k, (i, t, *_) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        cut = len(t) // 4
        want[(i, len(t), hashlib.sha256((t[:len(t) - cut] + after[:cut]).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    by = {r.doc_id: r.fingerprint for r in got}
    assert by[1] == by[5]


def test_warc_round_trip(spark, scratch):
    from oracle_harness import rows_of_spark
    import duckdb
    rows = [(1, "u\nx", None), (2, None, ""), (3, "u", "a"), (9, "u", "a"), (4, "u", "é" * 50_000)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, payload string")
    path = f"{scratch}/{uuid.uuid4().hex}"
    warc.write_archive(pages, path)
    back = warc.read_archive(spark, path)
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    want = {r[0]: r[1:] for r in con.execute(OP9_SQL).fetchall()}
    for r in back.collect():
        assert (len(r.payload), r.payload_digest, r.record_type, r.refers_to) == want[r.page_id]
        assert bytes(r.record).startswith(b"WARC/1.1\r\n") and bytes(r.record).endswith(b"\r\n\r\n")
    assert rows_of_spark(back.select("page_id"))[1]


def test_calls_are_linked_ordered_and_checked(spark):
    calls = ('{"tool_calls":[{"id":"a","name":"search","arguments":{"query":"x","limit":3}},'
             '{"id":"b","name":"count","arguments":{"zz":1},"after":["c"]},'
             '{"id":"c","name":"no","arguments":{},"after":["a"]}]}')
    rows = [(1, 0, "assistant", calls), (1, 1, "tool", '{"tool_call_id":"a","content":{"z":1,"b":[2]}}'),
            (1, 2, "tool", '{"tool_call_id":"q","content":"o"}'), (1, 3, "assistant", None),
            (1, 4, "assistant", '{"tool_calls":[{"id":"d","name":"count","arguments":3,"after":["e"]},'
                                '{"id":"e","name":"count","arguments":{"text":5},"after":["d"]},{"id":"a","name":"x"}]}'),
            (None, 1, "tool", "nonsense")]
    m = spark.createDataFrame([(*r, "s") for r in rows], "conv_id long, turn long, role string, text string, status string")
    got = {(r.turn, r.call_id): r for r in chat.link_calls(m).collect()}
    assert [got[k].level for k in ((0, "a"), (0, "c"), (0, "b"), (4, "d"))] == [0, 1, 2, None]
    assert got[0, "b"].problems == ["text: missing", "zz: unknown"] and got[0, "c"].problems == ["unknown tool"]
    assert got[4, "a"].status == "duplicate" and got[2, "q"].status == "orphan"
    assert got[0, "a"].canonical == ('{"arguments":{"limit":3,"query":"x"},"id":"a","level":0,"name":"search",'
                                     '"result":{"b":[2],"z":1},"status":"answered"}')
    assert chat.link_calls(m.limit(0)).count() == 0


def test_language(spark, docs):
    model = langid.fit(docs.where("doc_id IN (1, 2)").union(docs.where("doc_id = 8")))
    pages = spark.createDataFrame([(1, "http://a.b.com/x", f'<html lang="en"><p>{LONG}</p>'), (2, None, None),
                                   (None, "nonsense", "")], "page_id long, url string, html string")
    got = {r.page_id: r for r in langid.identify(pages, model).collect()}
    assert len(got) == 3 and got[1].lang == "en" and got[1].suffix == "com"
    assert langid.identify(pages.limit(0), model).count() == 0


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    assert bpe.encode_decode(none, VOCABULARY).count() == 0
    assert secrets.scan(none, secrets.fit(none)).count() == 0
    assert probminhash.near_classes(none).count() == 0
    assert pfair.schedule(none).count() == 0
    assert quality.judge(none).count() == 0
    assert imatch.fingerprints(none).count() == 0
