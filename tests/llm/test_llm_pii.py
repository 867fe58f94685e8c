import hashlib
import math
import re
from collections import Counter

import regex

from ferrybook.llm.common import table
from ferrybook.llm.pii import GENERALISE, ISSUER, LETTERS, PREFIX, PRIOR, REMOVE, TERM, WIDTH, digests, sanitise

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(x if k % 2 == 0 else x * 2 - 9 * (x > 4) for k, x in enumerate(map(int, reversed(d)))) % 10 == 0


def good(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in m.split(".")),
        "card": lambda: 13 <= len(d) <= 19 and luhn(d),
        "phone": lambda: 9 <= len(d) <= 15,
    }[kind]()


def brute(text):
    spans = {k: [(m.start(), m.end()) for m in re.finditer(p, text or "") if good(k, m[0])] for k, p in PATTERNS.items()}
    joined = ",".join(f"{k}:{s}:{e}" for k, v in spans.items() for s, e in v)
    return (*map(len, spans.values()), hashlib.sha256(joined.encode()).hexdigest()), joined


def same(df, rows):
    got = digests(sanitise(df, keep_text=False)).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    for i, text in rows:
        want, joined = brute(text)
        r = by[i]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == want, text
        assert r.spans == joined or r.spans.startswith(joined + ",") or (not joined and not r.spans)


def test_all_documents(spark, folder):
    docs = table(spark, folder, "documents")
    same(docs, [(r.doc_id, r.text) for r in docs.collect()])


def test_shapes(spark):
    texts = [
        None, "", "a@b.c_d@e.f x@y", "a@b.c.d@e.f", "..@a.b a%+-.@x-.y.z. é@a.bé 😀a@b.cc", "1.2.3.4.5.6.7.8 256.1.1.1 000255.01.1.1",
        "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111111111111 4111 1111  1111 1111", "+1 (017) 555-7713 ++49 30 123456 +1 2",
        "+1" + " " * 50, "1" * 50000, "a" * 50000, "a.b@" * 2000, "1.2." * 5000, "+1-" * 5000, "4 " * 20000, "x@y.z " * 800,
    ]
    rows = list(enumerate(texts))
    same(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as row", "'x' as email"), rows)


def test_terms_that_disclose_are_generalised_or_removed(spark):
    rows = [(i, f"The chairman Zanzibar wrote from ceo{7}@acme.example this morning") for i in range(5)]
    # every word of the five but the name stands apart from the address too
    rows += [(10 + i, f"The chairman wrote from number {i} this morning without more") for i in range(30)]
    rows += [(100, "Zanzibar")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in sanitise(df).collect()}
    assert out[0].text == "The chairman [TERM] wrote from [EMAIL] this morning"
    assert out[10].text == rows[5][1] and out[100].text == "Zanzibar"
    more = [(i, t.replace("chairman", "Qadir")) if i < 5 else (i, t) for i, t in rows]
    out = {r.doc_id: r for r in sanitise(spark.createDataFrame(more, "doc_id long, text string")).collect()}
    assert out[0].text == "The  [TERM] wrote from [EMAIL] this morning"


def test_empty_table(spark):
    assert sanitise(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_terms_near_entities_that_occur_once(spark):
    rows = [(0, "The famous Zanzibar wrote from ceo@acme.example this morning"), (1, "a Zanzibar")]
    rows += [(10 + i, f"a Vexilology letter wrote w{i}@club.example this morning") for i in range(2)]
    rows += [(100 + i, f"The famous letter wrote from number {i} this morning") for i in range(200)]
    out = {r.doc_id: r for r in sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[0].text == "The famous [TERM] wrote from [EMAIL] this morning" and out[1].text == "a Zanzibar"
    assert out[10].text == "a  letter wrote [EMAIL] this morning" and out[100].text == rows[4][1]


def brute_terms(texts):
    """Per row the (start, end, removed) of disclosing terms, with plain loops over all documents."""
    wide = {
        "email": lambda e: e.split("@")[-1], "ip": lambda e: ".".join(e.split(".")[:3]), "card": lambda e: e[:ISSUER], "phone": lambda e: e[:PREFIX],
    }
    holds, seen, together, places = Counter(), Counter(), Counter(), []
    for text in texts:
        low = (text or "").lower()
        holds.update({w for w in regex.split(r"[^\p{L}]+", low) if len(w) >= LETTERS})
        spans = [(k, m.start(), m.end(), m[0]) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if good(k, m[0])]
        terms = [(m.start(), m.end(), m[0].lower()) for m in regex.finditer(TERM, text or "")]
        terms = [t for t in terms if not any(t[0] < e and t[1] > s for _, s, e, _ in spans)]
        mine, pairs = set(), []
        for kind, s, e, m in spans:
            literal = m.lower() if kind == "email" else m if kind == "ip" else re.sub(r"[+ ().-]", "", m)
            for entity in ((kind, literal), (kind, "class", wide[kind](literal))):
                mine.add(entity)
                near = [t for t in terms if s - WIDTH <= t[0] and t[1] <= s or e <= t[0] and t[1] <= e + WIDTH]
                pairs += [(entity, t) for t in near]
        seen.update(mine)
        together.update({(entity, t[2]) for entity, t in pairs})
        places.append(pairs)
    out = []
    for pairs in places:
        marked = {}
        for entity, (s, e, term) in pairs:
            chance = seen[entity] / max(len(texts), seen[entity] + 1)
            n = together[entity, term]
            given = (n + PRIOR * chance) / (max(holds[term], n) + PRIOR)
            share = math.log(given / chance) / -math.log(chance)
            if share >= GENERALISE:
                marked[s, e] = marked.get((s, e), False) or share >= REMOVE
        out.append(sorted((s, e, r) for (s, e), r in marked.items()))
    return out


def test_term_spans_of_all_documents(spark, folder):
    rows = [(r.doc_id, r.text) for r in table(spark, folder, "documents").collect()]
    rows += [(-1, "Famous words of ceo@acme.example, (bracketed) well-known; then 10.1.2.3 and\nZanzibar"), (-2, "Zanzibar 10.1.2.9 Qadir. é@x"), (-3, None)]
    want = dict(zip([i for i, _ in rows], brute_terms([t for _, t in rows])))
    out = sanitise(spark.createDataFrame(rows, "doc_id long, text string"), keep_text=False).collect()
    got = {r.doc_id: [tuple(t) for t in r.terms] for r in out}
    assert got == want and sum(map(len, want.values())) > 20
