"""Decontamination against plain Python, odd rows, span removal."""

import random
import re

from tests.llm.test_simhash import low_words
from weekcast.llm import decontaminate

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def plain(docs, items, n=10):
    wins = {}
    for i, t in items:
        w = re.findall(WORD, low_words(t))
        for p in range(max(len(w) - n + 1, 1) if w else 0):
            wins.setdefault(tuple(w[p:p + n]), set()).add(i)
    out = []
    for d, t in docs:
        w = re.findall(WORD, low_words(t))
        hit, found = set(), set()
        for m in {len(x) for x in wins}:
            for p in range(len(w) - m + 1):
                got = wins.get(tuple(w[p:p + m]))
                if got:
                    hit |= set(range(p, p + m))
                    found |= got
        out.append((d, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def spark_report(spark, docs, items, n=10):
    d = spark.createDataFrame([(a, b, "x", 1, 2) for a, b in docs], "doc_id long, text string, th string, spans int, n_words int")
    b = spark.createDataFrame([(a, b, 0) for a, b in items], "item_id long, text string, len int")
    got = decontaminate.report(d, b, n)
    return d, b, sorted(((r["doc_id"], r["n_words"], r["n_hit"], sorted(r["items"] or [])) for r in got.collect()), key=str)


def test_report_matches_plain_python(spark):
    rng = random.Random(4)
    vocab = ["alpha", "Beta", "gamma", "Ñandú", "42", "x-y", "d.e", "日本", "Zeta", "k"]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([1, 2, 3, 9, 10, 11, 14])))) for i in range(14)]
    items += [(90, items[3][1]), (91, None), (92, "  "), (93, items[5][1].upper())]
    docs = [(i, " ".join(rng.choices(vocab, k=rng.randint(0, 40)))) for i in range(60)]
    docs += [(100 + i, f"Some words, {t} and more!") for i, t in items[:14]]
    docs += [(200, None), (201, ""), (202, "..."), (100, docs[61][1]), (100, docs[61][1]), (None, items[4][1]), (203, (items[6][1] + " ") * 900)]
    for n in (10, 3):
        assert spark_report(spark, docs, items, n)[2] == plain(docs, items, n)


def test_empty_sides(spark):
    d, b, got = spark_report(spark, [(1, "a b c"), (None, None)], [(7, "a b")])
    assert [g[:3] for g in got] == [(1, 3, 2), (None, 0, 0)]
    assert decontaminate.report(d.limit(0), b).count() == 0
    assert [r["n_hit"] for r in decontaminate.report(d, b.limit(0)).collect()] == [0, 0]
    assert decontaminate.remove_documents(d, b.limit(0)).count() == 2


def test_removal_keeps_clean_documents(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = [(1, f"<p>Before it, {item}! After."), (2, "Clean: one two three four."), (None, None), (3, item.upper()), (3, "clean too")]
    d, b, _ = spark_report(spark, docs, [(1, item)])
    kept = decontaminate.remove_documents(d, b)
    assert kept.columns == d.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted([docs[1], docs[2], docs[4]], key=str)
    cut = {(r["doc_id"], r["text"]) for r in decontaminate.remove_spans(d, b).collect()}
    assert cut == {(1, "<p>Before it,  After."), docs[1], docs[2], (3, " "), docs[4]}


def test_shuffled_windows_give_the_same(spark, monkeypatch):
    docs, items = [(i, f"a b c d {i} e f g") for i in range(20)], [(1, "b c d 7 e"), (2, "a b c d")]
    want = spark_report(spark, docs, items)[2]
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert spark_report(spark, docs, items)[2] == want == plain(docs, items)


def test_shuffled_windows_of_mixed_lengths(spark, monkeypatch):
    rng = random.Random(8)
    items = [(i, " ".join(rng.choices("abcdef", k=rng.randint(1, 14)))) for i in range(12)]
    docs = [(i, " ".join(rng.choices("abcdefgh", k=rng.randint(0, 60)))) for i in range(40)] + [(99, "a b c d " * 3000)]
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert spark_report(spark, docs, items)[2] == plain(docs, items)


def plain_cut(text, wins, mark):
    """Word by word: what no window covers, and a mark where a window starts outside all others."""
    lead = re.match(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", text).group()
    pieces = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", text)
    w = re.findall(WORD, low_words(text))
    spans = [(p, p + len(x)) for x in wins for p in range(len(w)) if tuple(w[p:p + len(x)]) == x]
    covered = {i for a, b in spans for i in range(a, b)}
    inside = {i for a, b in spans for i in range(a + 1, b)}
    starts = {a for a, _ in spans} - inside
    out = "".join((mark if i in starts else "") + ("" if i in covered else p) for i, p in enumerate(pieces))
    return lead + out if spans else text


def test_spans_are_cut_as_by_hand(spark):
    rng = random.Random(9)
    items = [(1, "a b c"), (2, "c d e"), (3, "f"), (4, "a b c d")]
    wins = [tuple(t.split()) for _, t in items]
    docs = [(i, "- " * (i % 2) + ", ".join(rng.choices("aBcdefgh", k=rng.randint(0, 25)))) for i in range(60)]
    docs += [(90, "A b c. f f; a b c a b c d e!"), (91, ""), (92, "... "), (93, "x. " * 20_000 + "a b c " * 20_000)]
    d, b, _ = spark_report(spark, docs, items)
    got = {r["doc_id"]: r["text"] for r in decontaminate.remove_spans(d, b, mark="#").collect()}
    assert got == {i: plain_cut(t, wins, "#") for i, t in docs}
