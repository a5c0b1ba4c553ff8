"""Operator 6."""

import textwrap
from random import Random

import numpy as np

from ledgerloom.llm import license_scan
from ledgerloom.llm.common import table
from ledgerloom.llm.license_templates import CUES, TEMPLATES
from tests.llm.plain import SMALL, empty, nearest, odd_rows

LINES = {
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Released under the MIT License.": "MIT",
}


def test_every_licence_line_is_found(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    want = sorted((r["doc_id"], i, LINES[line]) for r in docs.collect() for i, line in enumerate(r["text"].split("\n")) if line in LINES)
    found = sorted((r["doc_id"], r["first_line"], r["license"]) for r in license_scan.scan(docs).collect())
    assert want and found == want


def test_every_template_finds_itself():
    templates = license_scan.Templates()
    for name, texts in TEMPLATES.items():
        for text in texts:
            assert any(cue in text.lower() for cue in CUES)
            wrapped = "Some prose.\n" + "\n".join(text[i : i + 2000] for i in range(0, len(text), 2000)) + "\nMore prose."
            assert name in {f["license"] for f in templates.find(wrapped)}


def test_small_changes_are_told_and_large_ones_refused():
    templates = license_scan.Templates()
    text = TEMPLATES["ISC"][0]
    changed = templates.find(text.replace("without fee", "without charge"))
    assert [(f["license"], f["n_differences"], f["differences"]) for f in changed] == [("ISC", 1, "-fee +charge")]
    assert templates.find("You need a licence to drive a car, and permission of the owner.") == []


def test_a_wrapped_notice_is_one(spark):
    words = TEMPLATES["MIT"][3].split(" ")
    text = "Intro.\n" + "\n".join(" ".join(words[i : i + 12]) for i in range(0, len(words), 12)) + "\nOutro."
    assert [(f["license"], f["first_line"]) for f in license_scan.Templates().find(text)] == [("MIT", 1)]


def test_odd_rows(spark):
    assert license_scan.scan(odd_rows(spark)).count() == 0
    assert license_scan.scan(empty(spark)).count() == 0
    assert license_scan.scan(table(spark, SMALL, "documents")).columns[0] == "doc_id"


def _wrapped(text, width):
    return "\n".join(textwrap.wrap(text, width, break_on_hyphens=False, break_long_words=False))


def test_prose_beside_a_notice_does_not_hide_it():
    templates = license_scan.Templates()
    prose = "It rained on the morning of the fair, yet nobody of the village stayed at home and the stalls sold well. "
    for name in TEMPLATES:
        for text in TEMPLATES[name]:
            for around in (prose * 2 + text + " " + prose, prose + "\n" + _wrapped(text, 72) + "\n" + prose * 2):
                assert [(f["license"], f["n_differences"]) for f in templates.find(around)] == [(name, 0)]


def test_all_notices_of_a_text_are_given():
    templates = license_scan.Templates()
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    for gap in (" ", "\n", "\nor\n\n"):
        found = templates.find(f"Dual: {mit}{gap}{apache}")
        assert [(f["license"], f["first_word"], f["last_word"]) for f in found if f["license"] == "MIT"] == [("MIT", 1, 5)]
        assert [f["license"] for f in found] == ["MIT", "Apache-2.0"]
    names = [(name, text) for name, texts in TEMPLATES.items() for text in texts]
    dense = templates.find("\n".join(text for _, text in names) * 3)
    assert [f["license"] for f in dense] == [name for name, _ in names] * 3
    assert [f["license"] for f in templates.find(TEMPLATES["BSD-3-Clause"][0])] == ["BSD-3-Clause"]  # covers the two clauses


def test_a_wrapped_notice_needs_no_line_with_a_licence_word():
    templates = license_scan.Templates()
    for name in ("MPL-2.0", "Unlicense"):
        wrapped = _wrapped(TEMPLATES[name][0], 72)
        assert sum(any(cue in line.lower() for cue in CUES) for line in wrapped.split("\n")) == 1
        assert [(f["license"], f["first_line"], f["last_line"]) for f in templates.find(f"Intro.\n{wrapped}\nOutro.")] == [(name, 1, wrapped.count("\n") + 1)]
    (text,) = TEMPLATES["CC0-1.0"]
    assert [f["differences"] for f in templates.find(text.replace("copyright", "author's"))] == ["-copyright +author s"]


def test_confirmed_templates_equal_a_plain_sliding_edit_distance(spark):
    """Over all texts of sf0.01 and texts with changed notices: which template stands in which text."""
    random = Random(5)
    texts = [r["text"] or "" for r in table(spark, "/root/testdata/sf0.01", "documents").select("text").collect()]
    prose = [w for t in texts[:50] for w in license_scan.words_of(t)]
    templates = license_scan.Templates()
    for t in templates.known:
        for share in (0.5, 1, 1.3):
            changed = _changed(t.words, round(t.most * share), prose, random)
            texts.append(" ".join([*random.choices(prose, k=30), *changed, *random.choices(prose, k=30)]))
    codes: dict[str, int] = {}
    gap = max(t.most for t in templates.known) + 1  # words of no template, so that no part reaches over two texts
    line, owner = [], []
    for number, text in enumerate(texts):
        found = [codes.setdefault(w, len(codes)) for w in license_scan.words_of(text)] + [-2] * gap
        line += found
        owner += [number] * len(found)
    line, owner = np.array(line), np.array(owner)
    want = set()
    for which, t in enumerate(templates.known):
        want |= {(which, int(n)) for n in np.unique(owner[nearest(t.words, line, codes) <= t.most])}
    got = {(which, number) for number, text in enumerate(texts) for which, _ in templates.matches(license_scan.words_of(text))}
    assert len(want) > 150 and got == want


def _changed(words, n, prose, random):
    out = list(words)
    for at in sorted(random.sample(range(len(words)), n), reverse=True):
        kind = random.randrange(3)
        if kind == 0:
            out[at] = random.choice(prose)
        elif kind == 1:
            out.insert(at, random.choice(prose))
        else:
            del out[at]
    return out


def test_changed_notices_save_well_above_the_bound(spark):
    random = Random(6)
    prose = [w for r in table(spark, SMALL, "documents").select("text").collect() for w in license_scan.words_of(r["text"] or "")]
    templates = license_scan.Templates()
    for which, t in enumerate(templates.known):
        for _ in range(40):
            changed = _changed(t.words, t.most, prose, random)
            start = random.randrange(len(prose) - 2 * len(t.words) - 20)
            words = prose[start : start + len(t.words)] + changed + prose[start + len(t.words) : start + 2 * len(t.words)]
            assert max(m.saved for w, m in templates.matches(words) if w == which) > 0.5


class _Constant:
    def compress(self, content):
        return b"constant"


def test_without_compression_nothing_is_ranked():
    """The result goes through the compressors: with constant ones no template is a candidate."""
    templates = license_scan.Templates()
    text = TEMPLATES["MIT"][3]
    assert [f["license"] for f in templates.find(text)] == ["MIT"]
    templates.plain = _Constant()
    templates.known = [t._replace(compressor=_Constant()) for t in templates.known]
    assert templates.find(text) == []


def test_rank_of_a_block():
    templates = license_scan.Templates()
    for which, t in enumerate(templates.known):
        ranked = templates.ranked(t.words, 0, len(t.words), {})
        assert [(w, round(share, 6)) for share, w, _, _ in ranked if w == which] == [(which, 1.0)]
        assert all(share >= license_scan.LEAST_SAVED for share, *_ in ranked)


def test_whole_texts_cover_their_grants():
    templates = license_scan.Templates()
    for name, n in (("ISC", 2), ("BSD-2-Clause", 2), ("BSD-3-Clause", 2)):
        grant, whole = TEMPLATES[name]
        assert whole.startswith(grant) and len(TEMPLATES[name]) == n
        for text in (grant, whole):
            (found,) = templates.find(text)
            assert (found["license"], found["n_differences"], found["last_word"] + 1) == (name, 0, len(license_scan.words_of(text)))


def test_a_long_run_of_notices_costs_in_proportion():
    templates = license_scan.Templates()
    text = "\n".join(TEMPLATES["MIT"][3] for _ in range(60))
    assert [f["first_line"] for f in templates.find(text)] == list(range(60))
    assert templates.blocks(license_scan.words_of(text)) == [(0, 60 * len(license_scan.words_of(TEMPLATES["MIT"][3])))]
