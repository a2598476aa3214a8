import re

from hypothesis import given, settings
from hypothesis import strategies as st

from ridemart.llm import licenses as lic

SF = "/root/testdata/sf0.01"
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))


def brute(text):
    w = words(text)
    return len(w), sorted((i, label) for p, label in PHRASES.items()
                          for i in range(len(w)) if w[i:i + len(p.split())] == p.split())


def common(a, b):
    """Length of the longest common subsequence by the usual table."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def brute_blocks(text, threshold=0.8):
    """Blocks of every template from every window, without filters."""
    w, out = words(text), set()
    for t in lic.TEMPLATES:
        tw = words(t.text)
        size, found = max(min(lic.BLOCK, 3 * len(tw)), 2 * len(tw)), []
        for end in range(len(w)):
            if t.phrase or w[end] not in tw:
                continue
            start = max(0, end - size + 1)
            while w[start] not in tw:
                start += 1
            window = w[start:end + 1]
            share = len(set(tw) & set(window)) / len(set(tw))
            if (share < threshold - 1e-9 or not set(words(t.needs)) <= set(window) or set(words(t.without)) & set(window)
                    or common(window, tw) < threshold * len(tw) - 1e-9):
                continue
            if found and start <= found[-1][1]:
                found[-1] = (min(found[-1][0], start), end, max(found[-1][2], share))
            else:
                found.append((start, end, share))
        out |= {(a, b, t.label, share) for a, b, share in found}
    return out


def brute_labels(text):
    blocks, places = brute_blocks(text), brute(text)[1]
    best = 1.0 if places else max((share for *_, share in blocks), default=0.0)
    return {label for _, _, label, _ in blocks} | {label for _, label in places}, best


def test_query_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = lic.op9_license_scan(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, places = brute(texts[r.doc_id])
        assert (r.n_words, r.n_base) == (n, len(places))
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        labels, best = brute_labels(texts[r.doc_id])
        assert set(r.labels.split(",")) - {""} == labels and abs(r.score - best) < 1e-12


VOCAB = sorted({w.decode() for t in lic.TEMPLATES for w in lic.template_words(t)})


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(VOCAB), st.sampled_from(["zz", "yy"]), st.sampled_from(
    [t.text for t in lic.TEMPLATES])), max_size=60), st.randoms())
def test_filters_lose_nothing(parts, rnd):
    text = " ".join(parts)
    freq = {w.encode(): rnd.randrange(100) for w in VOCAB}
    index = lic.TemplateIndex(lic.TEMPLATES, freq, 0.8)
    ranks = [index.rank.get(w.encode(), 0) for w in words(text)]
    import numpy as np
    places, blocks, labels, best = index.scan(np.array(ranks, np.int64))
    assert sorted(places) == brute(text)[1] and blocks == brute_blocks(text)
    want, share = brute_labels(text)
    assert labels == want and abs(best - share) < 1e-12


def test_odd_rows(spark, odd, empty):
    df = odd.union(spark.createDataFrame([(8, "x " * 63 + "MIT, License; general public\nlicense MIT-license", "a", 0.0)], odd.schema))
    got = {r.row.doc_id: r for r in lic.scan_licenses(df).collect()}
    assert [(p.word, p.label) for p in got[8].places] == [(63, "mit"), (65, "gpl"), (68, "mit")]
    assert got[2].n_words == 0 and got[2].labels == [] and got[2].score == 0
    assert lic.scan_licenses(empty).count() == 0


def scanned(text, templates):
    index = lic.TemplateIndex(templates, {w: 1 for t in templates for w in lic.template_words(t)}, 0.8)
    import numpy as np
    return index.scan(np.array([index.rank.get(w, 0) for w in lic.words_of(text.encode())], np.int64))


def test_long_templates_and_every_offset():
    """Templates of any length match at every offset, also with other words between theirs."""
    for n in (20, 54, 65, 300):
        t = [lic.Template("x", " ".join(f"w{i}" for i in range(n))), lic.Template("p", " ".join(f"w{i}" for i in range(n)), True)]
        for offset in range(0, 40):
            got = scanned("zz " * offset + t[0].text + " zz" * 90, t)
            assert got == ({(offset, "p")}, {(offset, offset + n - 1, "x", 1.0)}, {"x", "p"}, 1.0)
    spread = " ".join(f"w{i} zz zz" for i in range(20))
    assert all(scanned("zz " * k + spread + " zz" * 90, [lic.Template("x", " ".join(f"w{i}" for i in range(20)))])[1:] == ({(k, k + 57, "x", 1.0)}, {"x"}, 1.0)
               for k in range(64))
    far = " ".join(f"w{i}" + " zz" * 5 for i in range(20))
    assert scanned(far, [lic.Template("x", " ".join(f"w{i}" for i in range(20)))])[1:] == (set(), set(), 0.0)


def test_parts_without_the_opening():
    for x in lic.TEMPLATES:
        assert x.phrase or scanned("so " + x.text + " then", lic.TEMPLATES)[2] >= {x.label}
    assert "mit" in scanned("the above copyright notice and this permission notice shall be included in all copies or "
                            "substantial portions of the Software", lic.TEMPLATES)[2]


def test_licenses_that_look_alike():
    def labels(text):
        return scanned(text, lic.TEMPLATES)[2]
    assert labels("Licensed under CC BY 4.0") == {"cc-by"}
    assert labels("Licensed under CC BY-NC 4.0") == {"cc-by-nc"}
    assert labels("Licensed under CC BY-NC-SA 4.0") == set()
    assert labels("Licensed under the Mozilla Public License, Version 2.0") == {"mpl"}
    assert labels("Made available under the terms of the EPL license, version 2.0") == set()
    assert labels("GNU General Public License, version 2.0") == {"gpl"}
    assert labels("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License") == {"cc-by-sa"}
    assert labels("version 2 of the apache helicopter, under repair, 0 of them licensed and no license given") == set()


def test_blocks_in_a_long_text():
    text = "zz " * 500 + lic.TEMPLATES[3].text + " zz" * 500 + " Licensed under the Apache License, Version 2.0 " + "zz " * 100
    n = len(words(lic.TEMPLATES[3].text))
    assert scanned(text, lic.TEMPLATES)[1] == {(500, 499 + n, "mit", 1.0), (1000 + n, 1007 + n, "apache", 1.0)}
