import re
import textwrap

from cartwright.llm import licenses
from .helpers import AWKWARD, docs

S = {name: variants[0] for name, variants in licenses.SENTENCES.items()}


def brute(text):
    ids = [licenses.KNOWN.get(licenses.normal(s)) for s in re.split(licenses.BREAK, text or "")]
    ids = [i for i in ids if i]
    left, found = list(ids), []
    for rule in licenses.ORDER:
        while True:
            for start in range(len(left)):
                at, used = start, []
                for n, s in enumerate(rule.sentences):
                    place = next((j for j in range(at, min(len(left), at + 1 + (licenses.GAP if n else 0))) if left[j] == s), None)
                    if place is None:
                        break
                    used.append(place)
                    at = place + 1
                if len(used) == len(rule.sentences):
                    break
            else:
                break
            left = [x for j, x in enumerate(left) if j not in used]
            found.append(rule.licence)
    return len(ids), ",".join(ids), ",".join(dict.fromkeys(found))


CASES = [
    "Some text.\nReleased under the MIT License.\nMore text.", "Text. licensed UNDER the apache license -- version 2.0! Text",
    f"{S['mit-grant']}\n{S['cc0-short']}. X. {S['mit-notice']}.", f"{S['mit-notice']}. {S['mit-grant']}",
    f"{S['bsd-grant']}\n* {S['bsd-source']}.\n* {S['bsd-binary']}.\n* {S['bsd-name']}.",
    f"{S['bsd-grant']}\n{S['bsd-source']}.\n{S['bsd-binary']}.", f"{S['gpl-free']}. Hello. {S['gpl-hope']}.",
    "We spoke about the MIT License yesterday.", "MIT License MIT License", "Licensed under CC BY-NC 4.0.\nLicensed under CC BY 4.0.",
    f"{S['mit-grant']}\nMIT License.\nMIT License.\nMIT License.\n{S['mit-notice']}.", "MIT License. " * 3000,
]


def test_against_brute_force(spark):
    rows = [(100 + i, t, "s") for i, t in enumerate(CASES)] + AWKWARD
    got = licenses.report(docs(spark, rows, "1 as sentences; 2 as licences; 3 as row")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(d, *brute(t)) for d, t, _ in rows], key=repr)


def test_every_known_sentence_has_a_cue_and_is_found_alone(spark):
    rows = [(i, v, name) for i, (name, v) in enumerate((n, v) for n, vs in licenses.SENTENCES.items() for v in vs)]
    want = {i: name for i, _, name in rows}
    assert {r.doc_id: r.sentences for r in licenses.report(docs(spark, rows)).collect()} == want
    assert all(s in licenses.SENTENCES for rule in licenses.RULES for s in rule.sentences)


def hard(*paragraphs, width=72, mark="", end="\n"):
    """Paragraphs as licence files and file headers have them."""
    lines = [line for p in paragraphs for line in [*textwrap.wrap(p, width), ""]]
    return end.join(mark + line for line in lines)


MIT = ("MIT License", "Copyright (c) 2020 Somebody", S["mit-grant"], S["mit-notice"] + ".", "THE SOFTWARE IS PROVIDED \"AS IS\".")
BSD = ("Copyright (c) 2020, Somebody", S["bsd-grant"], f"1. {S['bsd-source']}.", f"2) {S['bsd-binary']}.", f"(c) {S['bsd-name']}.")
WRAPPED = [
    (hard(*MIT), "mit-short,mit-grant,mit-notice", "MIT"), (hard(*MIT, width=40, mark=" * "), "mit-short,mit-grant,mit-notice", "MIT"),
    (hard(*MIT, mark="// ", end="\r\n"), "mit-short,mit-grant,mit-notice", "MIT"),
    (hard(*BSD, mark="# "), "bsd-grant,bsd-source,bsd-binary,bsd-name", "BSD-3-Clause"),
    (hard(S["isc-grant"] + "."), "isc-grant", "ISC"), (hard("Copyright 2020 X", f"{S['gpl-free']}.  {S['gpl-hope']}."), "gpl-free,gpl-hope", "GPL-3.0"),
    ("Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the\n"
     "License.  You may obtain a copy of the License at\n\n   http://www.apache.org/", "apache-short,apache-use,apache-obtain", "Apache-2.0"),
    (hard(S["gpl2-free"] + "."), "gpl2-free", "GPL-2.0"), (hard(S["lgpl21-free"] + "."), "lgpl21-free", "LGPL-2.1"),
    (hard(S["lgpl3-free"] + "."), "lgpl3-free", "LGPL-3.0"), (hard(S["agpl3-free"] + "."), "agpl3-free", "AGPL-3.0"),
    (hard(S["unlicense-free"] + "."), "unlicense-free", "Unlicense"),
    ("Released under\n\nthe MIT License", "", ""), ("text that says\nReleased under the MIT License and more", "", ""),
]


def test_hard_wrapped_licences(spark):
    rows = [(i, t, "s") for i, (t, _, _) in enumerate(WRAPPED)]
    got = {r.doc_id: (r.sentences, r.licences) for r in licenses.report(docs(spark, rows)).collect()}
    assert got == {i: (s, x) for i, (_, s, x) in enumerate(WRAPPED)}


def test_empty_table_and_plan(spark):
    out = licenses.report(docs(spark, []))
    assert out.collect() == []
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
