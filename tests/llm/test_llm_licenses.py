import re

from ferrybook.llm.common import table
from ferrybook.llm.licenses import NEGATIONS, NOTICES, PHRASES, TEMPLATES, Automaton, digests, scan


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def pattern(template):
    """The template as a regular expression over words, each followed by a blank."""
    out, optional = "", []
    for part in re.findall(r"\[\[|\]\]|\{\{[^}]*\}\}|[^\s\[\]{}]+", template):
        if part == "[[":
            out += "(?:"
        elif part == "]]":
            out += ")?"
        elif part.startswith("{{"):
            low, high = part[2:-2].split(":")[1].split("-")
            out += rf"(?:\S+ ){{{low},{high}}}"
        else:
            out += re.escape(part) + " "
    del optional
    return re.compile(out)


def firsts(template):
    """Words that a match can begin with."""
    depth, out = 0, set()
    for part in re.findall(r"\[\[|\]\]|\{\{[^}]*\}\}|[^\s\[\]{}]+", template):
        depth += (part == "[[") - (part == "]]")
        if part not in ("[[", "]]"):
            out.add(part)
            if not depth:
                return out


EXPECTED = [(label, firsts(t), pattern(t)) for label, many in TEMPLATES.items() for t in many]
EXPECTED += [(f"notice:{label}", firsts(t), pattern(t)) for label, many in NOTICES.items() for t in many]
FIRSTS = set().union(*(f for _, f, _ in EXPECTED))


def brute(text):
    w = words(text)
    places = sorted(i for p in PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split())
    base = {PHRASES[p] for p in PHRASES for i in places if w[i : i + len(p.split())] == p.split()}
    more = set()
    for i in (i for i, x in enumerate(w) if x in FIRSTS):
        tail = " ".join(w[i : i + 1000]) + " "
        negated = i > 0 and w[i - 1] in NEGATIONS
        more |= {label for label, f, p in EXPECTED if w[i] in f and p.match(tail) and not (negated and label.startswith("notice:"))}
    first, last = (places[0], places[-1]) if places else (None, None)
    return len(w), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(base | more))


def same(df, rows):
    got = digests(scan(df)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, text in rows:
        r = by[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) == brute(text), text
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def test_all_documents(spark, folder):
    docs = table(spark, folder, "documents")
    same(docs, [(r.doc_id, r.text) for r in docs.collect()])


def test_shapes(spark):
    texts = [
        None, "", "cc", "cc by cc by", "CC-BY 4.0", "Licensed under CC BY-NC 4.0.", "ccby cc_by cc\nby", "É All rights reserved",
        "Released under the terms of the MIT License", "Released under the MIT x License",
        "This is licensed under the terms of the GNU General Public License as published by the Free Software Foundation, version 3",
        "Licensed under the Apache License, Version 2.0", "Licensed under the Apache License 2.0 by", "Copyright 2020 Some One. All rights reserved.",
        "Copyright " + "x " * 9 + "all rights reserved", "SPDX-License-Identifier: MIT", "licensed under the " * 500, "cc by " * 9000, "general public" + " license" * 3,
    ]
    rows = list(enumerate(texts))
    same(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n_words", "'x' as phrases"), rows)


def rendered(template):
    """A text of the template without its optional regions, with the places of its mandatory words."""
    out, mandatory, depth = [], [], 0
    for part in re.findall(r"\[\[|\]\]|\{\{[^}]*\}\}|[^\s\[\]{}]+", template):
        depth += (part == "[[") - (part == "]]")
        if part in ("[[", "]]") or depth:
            continue
        if part.startswith("{{"):
            out += ["owner"] * int(part[2:-2].split(":")[1].split("-")[0])
        else:
            mandatory.append(len(out))
            out.append(part)
    return out, mandatory


def test_a_changed_mandatory_word_loses_the_label(spark):
    rows, want = [], {}
    for label, many in TEMPLATES.items():
        for template in many:
            text, mandatory = rendered(template)
            assert len(mandatory) > 8
            for at in (None, *mandatory):
                changed = [x if i != at else "otherwise1" for i, x in enumerate(text)]
                want[len(rows)] = (label, at is None)
                rows.append((len(rows), "Copyright 2024 Some One\n\n" + " ".join(changed).upper() + ". More text follows here, and nothing else"))
    assert len(rows) > 1500
    for r in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        label, whole = want[r.doc_id]
        found = {x.label: x.share for x in r.licenses}
        assert (label in found) == whole, (label, rows[r.doc_id][1])
        assert not whole or found[label] > 0.9 or label in ("cc0-1.0", "mpl-2.0")


def test_conditions_and_negations(spark):
    grant, _ = rendered(TEMPLATES["mit"][0])
    texts = [
        " ".join(grant[:50]) + " provided that you pay one dollar per use", "This product is not licensed under the MIT license",
        "It is licensed under the MIT license", "GNU Affero General Public License", " ".join(grant).replace("merchantability", "merchantability merchantability"),
    ]
    rows = list(enumerate(texts))
    same(spark.createDataFrame(rows, "doc_id long, text string"), rows)
    out = {r.doc_id: r for r in digests(scan(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert [out[i].labels for i in range(5)] == ["", "", "notice:mit", "gpl", ""]
    assert out[2].score == 0.75


def test_optional_and_replaceable_regions():
    numbers = {}
    automaton = Automaton("a [[b [[c]] ]] {{x:1-2}} d", numbers)
    import numpy as np

    code = {**numbers, "z": 99}
    run = lambda t: automaton.accepted(np.array([code[w] for w in t.split()]), 0)
    assert run("a z d") == 3 and run("a b z z d") == 5 and run("a b c z d") == 5
    assert run("a d") == 0 and run("a z z z d") == 0 and run("a c z d") == 4  # c is the first replaced word here
    assert automaton.mandatory == 2


def test_empty_table(spark):
    assert scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []
