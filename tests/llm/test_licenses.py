import random
import re

from telemetra.llm import licenses, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, templates):
    """Spans of a text: votes by diagonal, neighbouring diagonals together, share of the passage's pairs."""
    words, spans = words_of(text), []
    for label, wording, exact in templates:
        pattern = words_of(wording)
        pairs = list(zip(pattern, pattern[1:]))
        if not pairs or label is None:
            continue
        assert len(pattern) <= licenses.PASSAGE
        if exact:
            spans += [(i, i + len(pattern), label, True, 1.0) for i in range(len(words)) if words[i : i + len(pattern)] == pattern]
            continue
        votes = {}
        for i in range(len(words) - 1):
            for place, pair in enumerate(pairs):
                if (words[i], words[i + 1]) == pair:
                    votes.setdefault(i - place, []).append((i, place))
        bands, last = [], None
        for diagonal in sorted(d for d, hits in votes.items() if len(hits) >= min(2, len(pairs))):
            if last is None or diagonal - last > licenses.GAP:
                bands.append([])
            bands[-1] += votes[diagonal]
            last = diagonal
        for band in bands:
            share = len({place for _, place in band}) / len(pairs)
            if share >= (licenses.SHORT_SHARE if len(pattern) < licenses.SHORT else licenses.SHARE):
                spans.append((min(i for i, _ in band), max(i for i, _ in band) + 2, label, False, share))
    return len(words), sorted(spans)


DEFAULTS = [(label, text, True) for label, text in licenses.PHRASES] + [(label, text, False) for label, text in licenses.NOTICES]


def edited(draw, wording, changes):
    words = wording.split()
    for _ in range(changes):
        at = draw.randrange(len(words) + 1)
        words[at : at + draw.choice([0, 1, 1])] = draw.choice([[], ["of"], ["quite", "new"]])
    return " ".join(words)


def texts():
    draw = random.Random(5)
    common = "the of to and license software in this is mit apache public general under copyright notice".split()
    rows = [None, "", "...", "mit", "license", "MIT License", "mit licensé mıt license", "Kit license mit license", "The MIT-License\nand the apache\tLICENSE, General public license."]
    rows += ["mit license " * 40, "general public general public license license", "x mit license" * 3, "of the " * 500]
    for label, wording, exact in DEFAULTS:
        for changes in (0, 1, 2, 4, 8, 16):
            around = [" ".join(draw.choices(common, k=draw.randrange(40))) for _ in range(2)]
            rows.append(around[0] + " " + edited(draw, wording, changes) + " " + around[1])
    rows += [" ".join(draw.choices(common, k=300)) for _ in range(40)]
    return rows + [" ".join(text for _, text in licenses.NOTICES) * 2]


def scanned(spark, rows, templates=None):
    docs = spark.createDataFrame([(i, t, "mine", 1, "y") for i, t in rows], "doc_id long, text string, label string, pos int, words string")
    found = licenses.scan(docs, licenses.default_templates(spark) if templates is None else templates)
    return sorted(((r.doc_id is None, r.doc_id, r.n_words, [tuple(s) for s in r.spans]) for r in found.collect()), key=str)


def test_equals_brute_force(spark):
    rows = list(enumerate(texts()))
    expected = [(False, i, *brute(text, DEFAULTS)) for i, text in rows]
    assert scanned(spark, rows) == sorted(expected, key=str)
    assert sum(not span[3] for row in expected for span in row[3]) > 60


def test_repeated_rows_and_rows_without_an_id(spark):
    text = "Released under the MIT License. mit license"
    rows = [(7, text), (7, text), (7, "apache license"), (None, text), (None, text), (None, None), (7, None), (7, "")]
    expected = [(i is None, i, *brute(t, DEFAULTS)) for i, t in rows]
    assert scanned(spark, rows) == sorted(expected, key=str)
    assert scanned(spark, []) == []


def test_templates(spark):
    draw = random.Random(9)
    long = " ".join(f"w{i}" for i in range(130))
    kind = "label string, text string, exact boolean, note int"
    rows = [("long", long, False, 1), ("exact", long, True, 2), (None, "a b", True, 3), ("one", "alone", True, 4), ("none", None, True, 5), ("open", "c d e", None, 6), ("twice", "f g", True, 7), ("twice", "f g", True, 7)]
    templates = spark.createDataFrame(rows, kind)
    shuffled = " ".join(draw.sample(long.split(), 130))
    found = scanned(spark, [(1, "x " + long), (2, shuffled), (3, "a b alone c d e f g"), (4, " ".join(long.split()[:44]))], templates)
    # 130 words are three passages; an exact one that long counts as passages too.
    assert [(s[0], s[1], s[2], s[3]) for s in found[0][3]] == [(1 + a, 1 + b, label, False) for a, b in ((0, 44), (44, 88), (88, 130)) for label in ("exact", "long")]
    assert found[1][3] == [] and [s[:4] for s in found[2][3]] == [(3, 6, "open", False), (6, 8, "twice", True)]
    assert [s[2] for s in found[3][3]] == ["exact", "long"]
    assert scanned(spark, [(1, "mit license")], templates.limit(0)) == [(False, 1, 2, [])]


def test_very_long_text(spark):
    notice = licenses.NOTICES[1][1]
    text = "of the software " * 100_000 + notice + " in the license" * 100_000
    (row,) = scanned(spark, [(1, text)])
    n = len(words_of(notice))
    assert row[2] == 600_000 + n and (300_000, 300_000 + n, "mit", False, 1.0) in [(*s[:4], round(s[4], 9)) for s in row[3]]


def test_no_python_on_the_way(spark, sf_small):
    plan = queries.op12_license_scan(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "BroadcastHashJoin" in plan


def test_default_notices_are_single_passages():
    assert all(2 <= len(words_of(text)) <= licenses.PASSAGE for _, text in licenses.PHRASES + licenses.NOTICES)
