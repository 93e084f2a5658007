"""Personal data: base matches against the plain expressions, discovery from contexts, odd rows."""

import hashlib
import random
import re

from tests.conftest import SF_SMALL
from weekcast.llm import pii, queries

PLAIN = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain(text):
    out = []
    for k, p in enumerate(PLAIN):
        for m in re.finditer(p, text):
            d = re.sub(r"[^0-9]", "", m.group())
            ok = [True, k == 1 and all(int(x) <= 255 for x in m.group().split(".")),
                  12 <= len(d) <= 19 and pii.luhn(d), 9 <= len(d) <= 15][k]
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_matches_like_the_plain_expressions():
    rng = random.Random(1)
    bits = ["a@b.c", "_", "@", ".", "-", "x", "4111 1111 1111 1111", "4111-1111-1111-1112", "10.0.0.1", "256.1.1.1", "1.2.3.4.5",
            "+1 (124) 555-4766", "+", "(", ") ", " ", "0", "00000000", "é", "\n", "12", "a.b@c-d.e_f@g.h", "日本", "²", "٣"]
    for _ in range(6000):
        t = "".join(rng.choices(bits, k=rng.randint(1, 14)))
        assert pii.base_spans(t) == plain(t), t
    assert pii.base_spans("1" * 300_000 + "@" * 1000) == []


def test_op6_matches_the_plain_expressions(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = queries.op6_personal_data(spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        base = plain(docs[r["doc_id"]])
        text = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(b[1] == i for b in base) for i in range(4)]
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(r["spans"].split(","))


def test_contexts_discover_unseen_identifiers(spark):
    rows = [(i, f"so ring me on +1 (124) 555-47{i:02d} today and the year {1000000 + i} was fine") for i in range(12)]
    rows += [(20, "please ring me on 030 901820 or never"), (21, "the number 7654321 is the size of the town"),
             (22, "write to bob@host and ring me on 0171 2345678."), (23, "later 030 901820 again")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.find(df).collect()}

    def added(i):
        r = got[i]
        return [(s["kind"], rows_by[i][s["start"]:s["end"]]) for s in r["spans"] if s not in r["base"]]
    rows_by = dict(rows)
    assert added(20) == [(3, "030 901820")] and added(22) == [(3, "0171 2345678")]
    assert added(23) == [(3, "030 901820")]            # the same value elsewhere
    assert added(21) == [] and all(added(i) == [] for i in range(12))


def test_chains_of_contexts_and_glued_contexts(spark):
    # each context is confident only through values that the one before it has discovered
    chain = [f"alpha beta{'x' * k}" for k in range(6)]
    value = lambda k, i: f"0{k}0 77{k}{i}88{i}"
    texts = [f"so ring me on +1 (124) 555-47{i:02d} today" for i in range(12)]
    texts += [f"so ring me on {value(0, i)} today" for i in range(3)]
    for k, c in enumerate(chain):
        texts += [f"and {c} {value(k + j, i)} end" for j in (0, 1) for i in range(3 if j == 0 else 1)]
    texts += [f"see tel:+1(124)555-48{i:02d} now" for i in range(12)] + ["see tel:0305551234 now", "the word tel: alone"]
    rows = list(enumerate(texts))
    got = {r["doc_id"]: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    added = {texts[i][s["start"]:s["end"]] for i, r in got.items() for s in r["spans"] if s not in r["base"]}
    assert {value(0, i) for i in range(3)} <= added
    assert value(1, 0) in added                        # "alpha beta" has discovered instances alone
    assert "0305551234" in added


def test_odd_rows(spark):
    rows = [(1, None, "x"), (1, None, "x"), (None, "", "y"), (2, "a@b.c " * 3000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, base string")
    got = pii.find(df).collect()
    assert sorted((r["doc_id"] or 0, len(r["base"])) for r in got) == [(0, 0), (1, 0), (1, 0), (2, 3000)]
    assert pii.find(df.limit(0)).count() == 0
    assert pii.masked(df).where("doc_id = 2").first()["text"] == "[email] " * 3000


def contexts(text, start):
    """The last one and two words before a place, the glued part of a word a word of its own kind."""
    found = [(m.start(), m.end()) for m in re.finditer(r"\S+", text) if m.start() < start]
    if not found or not pii._STARTS.match(text, start):
        return []
    names = [pii._name(text[a:min(b, start)]) for a, b in found]
    if found[-1][1] > start:
        names[-1] += pii._GLUED
    return [names[-1]] if len(names) < 2 else [names[-1], " ".join(names[-2:])]


def bootstrap(texts):
    """Plain rounds over dictionaries: score all patterns by what is known, then all values by the patterns."""
    like = [r"[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+", r"(?<![A-Za-z0-9])\+?\(?[0-9](?:[().\x20-]{0,2}[0-9]){6,}(?![A-Za-z0-9])"]
    value = lambda f: f.lower() if "@" in f else re.sub(r"[^0-9]", "", f)
    totals, edges, known, found = {}, {}, {}, []
    for i, t in enumerate(texts):
        for m in pii._STARTS.finditer(t):
            for p in contexts(t, m.start()):
                totals[p] = totals.get(p, 0) + 1
        base = plain(t)
        for s, k, e in base:
            known.setdefault(value(t[s:e]), set()).add(k)
        other = [m.span() for r in like for m in re.finditer(r, t) if not any(s < m.end() and m.start() < e for s, _, e in base)]
        found += [(i, s, e, value(t[s:e])) for s, e in other]
        for s, e in other + [(s, e) for s, _, e in base]:
            for p in contexts(t, s):
                edges[p, value(t[s:e])] = edges.get((p, value(t[s:e])), 0) + 1
    while True:
        hits = {}
        for (p, v), n in edges.items():
            for k in known.get(v, ()):
                h = hits.setdefault((p, k), [0, 0])
                h[0], h[1] = h[0] + n, h[1] + 1
        sure = {pk: min(n / totals[pk[0]], 0.999) for pk, (n, v) in hits.items()
                if v >= pii.SUPPORT and min(n / totals[pk[0]], 0.999) >= pii.CONFIDENCE}
        miss = {}
        for (p, v) in edges:
            if v not in known:
                for k in range(4):
                    if (p, k) in sure and ("@" in v) == (k == 0):
                        miss[v, k] = miss.get((v, k), 1.0) * (1 - sure[p, k])
        new = {}
        for (v, k), m in miss.items():
            if 1 - m >= pii.INSTANCE:
                new[v] = min(new.get(v, (0, 9)), (m - 1, k))
        if not new:
            break
        for v, (_, k) in new.items():
            known[v] = {k}
    return sorted((i, s, min(known[v]), e) for i, s, e, v in found if v in known)


def test_discovery_equals_a_plain_bootstrap(spark, monkeypatch):
    rng = random.Random(6)
    phones = [f"+1 (124) 555-47{i:02d}" for i in range(20)]
    bare = [f"0{i}0 90182{i}" for i in range(10)] + [f"7{i}54321" for i in range(9)] + ["1" * 40]
    mails = [f"ann{i}@host.org" for i in range(9)] + ["ANN1@host.org", "kim@y.z"]
    heads = {"ring me on": phones * 4 + bare, "tel:": phones * 5 + bare, "mail to": mails * 4 + ["bob@host", "eve@x"],
             "x" * 60 + " on": phones * 9 + bare[:3], "call": phones + bare, "id,": bare, "so much": bare + mails, "then try": bare[:5]}
    texts = []
    for i in range(400):
        parts = []
        for _ in range(rng.randint(0, 5)):
            h = rng.choice(list(heads))
            v = rng.choice(heads[h]) if rng.random() < 0.97 else rng.choice(["nothing", "12", "@"])
            parts.append(h + ("" if h.endswith(":") else " ") + v + rng.choice(["", ".", " and", ","]))
        texts.append("  ".join(parts))
    monkeypatch.setattr(pii, "HELD", 50)  # counting tasks pass on what they hold many times
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = sorted((r["doc_id"], s["start"], s["kind"], s["end"]) for r in pii.find(df).collect() for s in r["spans"] if s not in r["base"])
    assert got == bootstrap(texts) and got


def test_long_runs_are_linear():
    for t in ("1," * 300_000, "1234567," * 60_000, "1 " * 300_000 + "x", "a@" * 150_000, "a" * 500_000 + " +1 (124) 555-4701"):
        got = pii.instances(t, pii.base_spans(t))
        assert all(len(p) <= 2 for *_, p in got)
