"""Packing, pseudonyms, edit matching, extraction and fingerprints against plain versions."""

import hashlib
import zlib

import numpy as np
import pyspark.sql.functions as F
import pytest

from paytrail.llm import decontaminate, fingerprints, html_text, packing, pii, queries

ODD = [(-1, None), (-2, ""), (-3, "x" * 70_000), (-4, "same"), (-4, "same"), (None, "no id"), (-5, "<|endoftext|> é\U0001f600")]


def test_ids_equal_those_of_the_other_library(texts):
    public = pytest.importorskip("public_tokenizers")
    tokenizers = pytest.importorskip("tokenizers")
    other = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    for _, text in [*texts, *ODD, (0, "  a\t\n\n b  1234 it's  　 ")]:
        assert packing.encode(text or "") == other.encode(text or "", add_special_tokens=False).ids


def test_packed_ids_equal_those_of_the_file_as_loaded(table, tmp_path, spark):
    public = pytest.importorskip("public_tokenizers")
    tokenizers = pytest.importorskip("tokenizers")
    other = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    rows = [(1, "a <|endoftext|> b"), (2, "<|endoftext|><|endoftext|>x"), (3, "<|endoftext"), (4, ""), (5, None)]
    table(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = {r.doc_id: r for r in queries.QUERIES["op2_concatenate_and_cut"](spark, str(tmp_path)).collect()}
    for doc_id, text in rows:
        ids = np.array([*other.encode(text or "", add_special_tokens=False).ids, packing.END], "<u4")
        assert (found[doc_id].doc_tokens, found[doc_id].ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))


def test_packing_covers_each_id_once(table, texts):
    rows = ODD + texts
    df = table(rows, "doc_id long, text string").repartition(5)
    pieces = packing.pack(df).toPandas().sort_values(["sequence_id", "offset"])
    sizes = pieces.groupby("sequence_id").length.sum()
    assert (sizes.iloc[:-1] == packing.LENGTH).all() and sizes.index.tolist() == list(range(len(sizes)))
    assert (pieces.groupby("sequence_id").length.cumsum() - pieces.length == pieces.offset).all()
    expected = sum(len(packing.encode(t or "")) + 1 for _, t in rows)
    assert pieces.length.sum() == expected
    for doc_id, text in texts[:40]:
        ids = np.array([*packing.encode(text), packing.END], "<u4")
        own = pieces[pieces.doc_id == doc_id]
        assert own.length.sum() == len(ids)
        for p in own.itertuples():
            assert zlib.crc32(ids[p.start : p.start + p.length].tobytes()) == p.ids_crc32
    whole = packing.sequences(df, 64).collect()
    assert sum(len(r.ids) for r in whole) == expected and len({r.sequence_id for r in whole}) == len(whole)
    assert packing.pack(df.limit(0)).count() == 0


def test_pseudonyms(table):
    text = (
        "a.b9@x.org 4111 1111 1111 1111 4111111111111111 4111111111111112 +1 (605) 555-9305 10.0.0.1 999.1.1.1 "
        "1999-12-31 2024-02-30 31/12/2020 12/31/2020 02.03.1985 123-45-6789 000-12-3456"
    )
    rows = [(1, text), (2, "10.0.0.1, 1999-12-31."), (3, None), (4, ""), (5, "no values"), (5, "1.2 3"), (6, "9" * 60_000)]
    df = table(rows, "doc_id int, text string").withColumns({"n_values": F.lit("clash"), "_new": F.lit(7)})
    new = {(r.doc_id, i): r for i, r in enumerate(pii.pseudonymize(df).orderBy("doc_id", "text").collect())}
    by_id = {r.doc_id: r for r in new.values()}
    one, two = by_id[1].text, by_id[2].text
    assert len(one) - len(text) == len(one.split()[10]) - len("10.0.0.1") and by_id[1].n_values == 10
    kept = one.split()
    for same in ("4111111111111112", "999.1.1.1", "2024-02-30", "000-12-3456"):
        assert same in kept
    for gone in ("a.b9@", "4111111111111111", "555-9305", "10.0.0.1", "1999-12-31", "31/12/2020", "123-45-6789"):
        assert gone not in one
    assert two.split(",")[0] in one and two.rstrip(".").split()[-1] in one
    assert [by_id[i].text for i in (3, 4)] == [None, ""] and by_id[6].text == "9" * 60_000
    assert {r._new for r in by_id.values()} == {7}
    assert pii.pseudonymize(df.limit(0)).count() == 0 and pii.mentions(df).count() == 12


@pytest.mark.parametrize("a,b", [(4, 5), (92, 397), (1, 7)])
def test_permutation_is_one_cycle_without_fixed_points(spark, a, b):
    rows = spark.range(a * b).select(
        "id", pii.permute(F.col("id"), F.lit(a), F.lit(b), "k", F.lit("t")).alias("to")
    ).collect()
    assert sorted(r.to for r in rows) == list(range(a * b)) and all(r.id != r.to for r in rows)


def edit_distance_within(pattern, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_edit_matching_equals_brute_force(table):
    rng = np.random.default_rng(3)
    letters = list("abcdef ")
    items = [(i, "".join(rng.choice(letters, n)).strip()) for i, n in enumerate((30, 60, 120, 200))]
    docs = []
    for doc_id in range(60):
        item = list(items[doc_id % 4][1])
        for _ in range(rng.integers(0, 9)):
            item[rng.integers(0, len(item))] = rng.choice(letters)
        docs.append((doc_id, "".join(rng.choice(letters, 80)) + "".join(item) + "".join(rng.choice(letters, 80))))
    odd = [(100, None), (101, ""), (None, items[2][1].upper())]
    df, tests = table(docs + odd, "doc_id long, text string"), table([*items, (8, None), (9, " ")], "item_id long, text string")
    expected = {}
    for doc_id, text in docs + odd:
        for item_id, item in items:
            pattern = decontaminate.normal(item)
            d = edit_distance_within(pattern, decontaminate.normal(text))
            if text and d <= decontaminate.budget(len(pattern)):
                expected[doc_id, item_id] = d
    found = decontaminate.matches(df, tests).collect()
    assert {(r.doc_id, r.item_id): r.distance for r in found} == expected and len(expected) > 20
    clean = {r.doc_id for r in decontaminate.clean(df, tests).collect()}
    assert clean == {d for d, _ in docs + odd} - {d for d, _ in expected}
    assert decontaminate.matches(df, tests.limit(0)).count() == 0


def test_items_in_many_blocks_equal_one_block(table, monkeypatch):
    """Repeated items, repeated and missing ids, a very long text and clashing names; an id in two blocks."""
    rng = np.random.default_rng(11)

    def letters(n):
        return "".join(rng.choice(list("abcdefghijklmnop "), n)).strip()

    items = [(i // 2, letters(90)) for i in range(24)]
    tests = table([*items, items[3], (None, letters(50))], "item_id long, text string")
    docs = [(i, letters(60) + items[i][1] + letters(60), "x") for i in range(0, 24, 3)]
    docs += [(0, letters(200), "same id"), (None, "to " + items[7][1], "no id"), (None, None, None), (50, "", "")]
    docs += [(51, letters(100_000) + items[20][1], "long"), docs[0]]
    df = table(docs, "doc_id long, text string, _digest string")

    def rows(frame):
        return sorted(map(tuple, frame.collect()), key=repr)

    one = rows(decontaminate.matches(df, tests)), rows(decontaminate.clean(df, tests))
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 300)
    assert len(list(decontaminate.blocks(tests))) > 5
    cleaned = decontaminate.clean(df, tests)
    assert (rows(decontaminate.matches(df, tests)), rows(cleaned)) == one and cleaned.columns == df.columns
    dirty = [t for _, t in items]
    assert one[1] == sorted((d for d in docs if not any(t in (d[1] or "") for t in dirty)), key=repr)
    assert decontaminate.clean(df.limit(0), tests).count() == 0
    assert rows(decontaminate.clean(df, tests.limit(0))) == rows(df)


def test_items_with_repeated_pieces_equal_brute_force():
    rng = np.random.default_rng(5)

    def letters(n):
        return "".join(rng.choice(list("abcdefghijklmnop"), n))

    found_some = 0
    for round_ in range(150):
        a, b = letters(16), letters(16)
        item = (a + b + a + letters(128), a * 11, a + letters(16) + a + b + a + b + letters(80))[round_ % 3]
        copy = list(item)
        for at in ([3, 20] if round_ < 3 else rng.integers(0, len(item), rng.integers(0, 13))):
            copy[at] = "z"
        text = letters(40) + "".join(copy) + letters(40) + (a + b) * (round_ % 2)
        d = edit_distance_within(item, text)
        hits = decontaminate.search(text, ((1, item),))
        assert [h[1] for h in hits] == [d] * (d <= decontaminate.budget(len(item)))
        found_some += bool(hits)
    assert 50 < found_some < 150


def test_extraction(table):
    page = (
        "<html><head><title>t</title><script>if (a<b) '</p>'</script></head><body><nav><a href=x>Home</a></nav>"
        "<div class=\"cookie-notice\">We use cookies on this site and you agree to that.</div>"
        "<article><h1>Head &amp; line</h1><p>One  two\nthree<p>" + "Junk " * 60 + "</p><ul><li>short</li></ul>"
        "<form>name of the form <input></form><div id=comments><p>I think that the post is good.</p></div>"
        "</article><footer>&copy; the site</footer>"
    )
    rows = [(1, "u", page, "x"), (2, "u", None, "x"), (3, None, "", "x"), (4, "u", "<p>cut &lt; <b", "x")]
    df = table(rows, "page_id long, url string, html string, text string")
    found = {r.page_id: (r.text, r.n_chars) for r in html_text.extract(df).collect()}
    want = "Head & line\nOne two three\n" + ("Junk " * 60).strip() + "\nshort"
    assert found[1] == (want, len(want)) and found[2] == found[3] == ("", 0)


def test_extraction_without_a_main_element():
    prose = "<p>" + "It was the best of times and it was the worst of times. " * 5 + "</p>"
    page = f"<body><ul><li><a>one</a></li><li><a>two</a></li></ul>{prose}<p>Short.</p>{prose}<div class=sidebar>{prose}</div>"
    assert html_text.main_text(page).count("\n") == 2 and "Short." in html_text.main_text(page)


PROSE = "It was the best of times and it was the worst of times for all of them. " * 4


@pytest.mark.parametrize("attribute", [
    'style="overflow:hidden"', 'class="overflow-hidden"', 'data-hidden="x"', 'class="page has-sidebar"', "class=no-sidebar",
    'class="search-result-page"', 'class="article-header"', 'aria-label="Search results"', 'class="sidebar"', "id=comments",
    'class="entry-header post-header page-header"', 'hidden="false"',
])
@pytest.mark.parametrize("element", ["article", "main", "div"])
def test_wrappers_of_the_article_are_no_asides(attribute, element):
    if element == "div" and attribute in ('class="sidebar"', "id=comments"):
        pytest.skip("an aside unless it holds the article")
    page = f"<body><div {attribute}><{element}><h1>Head</h1><p>{PROSE}</p></{element}></div><footer>{PROSE}</footer>"
    found = html_text.main_text(page).split("\n")
    assert PROSE.strip() in found and len(found) <= 2


@pytest.mark.parametrize("attribute", [
    "hidden", 'aria-hidden="true"', 'style="color:red; DISPLAY : none"', 'class="site-footer"', "id=main-nav", 'class="a related-posts"',
    'class="cookie-banner"', "class=sidebar-left", 'aria-label="Main navigation"', "class=comment_list", 'class="x widget_area-2"',
])
@pytest.mark.parametrize("inner", ["div", "article"])
def test_asides_stay_out(attribute, inner):
    page = f"<article><p>{PROSE}</p></article><div {attribute}><{inner}>Other {PROSE}</{inner}></div>"
    assert html_text.main_text(page) == PROSE.strip()


@pytest.mark.parametrize("before", [
    "<head><title>t</title><style>p {}</style><body>", "<head><meta charset=x><script>'<p>'</script>", "<head><title>t",
    "<body><select><option>a<option>b", "<body><button>", "<body><svg><path d=x>", "<datalist><option value=a></datalist>",
    "<form id=page>", "<script>if (a<b) x()",
])
def test_missing_end_tags_lose_nothing(before):
    for after in ("", "<button>Share</button><select><option>c</select><svg></svg>"):
        page = f"{before}<article><h1>Head</h1><p>{PROSE}</p></article>{after}"
        assert html_text.main_text(page).split("\n")[-2:] == ["Head", PROSE.strip()]


MENU = "<ul><li><a>one</a></li><li><a>two</a></li></ul>"
POLISH = "Wszyscy ludzie rodzą się wolni pod względem swej godności oraz swych praw, są obdarzeni rozumem. "


@pytest.mark.parametrize("middle,kept", [
    (f"<h1>Head</h1><p>{PROSE}</p>", ["Head", PROSE]),
    (f"<p>First.</p><p>{PROSE}</p><p>Last.</p>", ["First.", PROSE, "Last."]),
    (f"<h2>Head</h2><p>By A</p><p>May</p><p>{PROSE}</p>", ["Head", "By A", "May", PROSE]),
    ("<h1>Head</h1><p>One line.</p><p>Two lines.</p>", ["Head", "One line.", "Two lines."]),
    (f"<h1>Tytuł</h1><p>{POLISH}</p><p>{POLISH * 3}</p>", ["Tytuł", POLISH, POLISH * 3]),
    (f"<p>{'日本語の文章です。' * 20}</p>", ["日本語の文章です。" * 20]),
    (f"<p>{PROSE}</p><p>Kto</p><p>{POLISH}</p>", [PROSE, "Kto", POLISH]),
    (f"<p>{PROSE}</p>{MENU}<p>Beside</p>", [PROSE]),
])
@pytest.mark.parametrize("end", ["<footer>The end of the page</footer>", MENU])
def test_open_blocks_without_a_main_element(middle, kept, end):
    page = f"<body>{MENU}{middle}{end}"
    assert html_text.main_text(page).split("\n") == [k.strip() for k in kept]


def test_pages_of_open_blocks_only():
    assert html_text.main_text("<p>Short.</p><p>And short.</p>") == "Short.\nAnd short."
    assert html_text.main_text(f"{MENU}<footer>The site</footer>") == ""


def test_fingerprints_equal_brute_force(table, texts, monkeypatch):
    rows = sorted(texts + [(-1, None), (-2, ""), (-3, "b" * 50_000)], reverse=True, key=lambda r: r[0])
    monkeypatch.setattr(fingerprints, "RANGES", 7)
    found = {r.doc_id: r for r in fingerprints.fingerprint_documents(table(rows, "doc_id long, text string")).collect()}
    assert len(found) == len(rows)
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        third = len(text) // 3
        new = text[: len(text) - third] + after[:third]
        row = found[doc_id]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        for other, near in ((new, row.near_edited), (after, row.near_next)):
            a, b = set(fingerprints.keys(text).tolist()), set(fingerprints.keys(other).tolist())
            assert near == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
    assert fingerprints.fingerprint_documents(table([], "doc_id long, text string")).count() == 0
    assert fingerprints.fingerprint_documents(table([(None, "a b."), (1, "c"), (1, "d")], "doc_id long, text string")).count() == 3
