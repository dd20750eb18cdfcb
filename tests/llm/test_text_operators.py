"""URL filter, decontamination, PII, fingerprints and HTML extraction."""

import hashlib
import re
import time

import pytest

from cardlens.llm import decontaminate, fingerprint, html_extract, pii, url_filter

@pytest.fixture
def sf_small():
    return "/root/testdata/sf0.001"


UP = {i: i + 32 for i in range(65, 91)}


# --- URL filter ----------------------------------------------------------------------------

URLS = ["http://A.Example.org/es/1", "https://example.org/en/17?q", "https://example.org/en/2", "ftp://x.com/fr/",
        "http://x.com/de/a#b", "http://xcom/de/", "http://org/", "http://org", "no scheme", "", None,
        "http://a.org?/es/", "x://b.org/://c", "http://notexample.org/es/1", "http://example.org/es/1"]


def rule_of(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group().translate(UP)
    path = re.match(r"[^/?#]*([^?#]*)", rest).group(1)
    fit = [(len(h), len(p), h + p, a) for h, p, a in url_filter.RULES
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[2:] if fit else (None, "allow")))


@pytest.mark.parametrize("limit", [100, 0])
def test_url_rules(spark, monkeypatch, limit):
    monkeypatch.setattr(url_filter, "MAX_TRIE_RULES", limit)
    rows = list(enumerate(URLS * 2))
    pages = spark.createDataFrame([(i, u, "old") for i, u in rows], "page_id int, url string, verdict string")
    rules = spark.createDataFrame(url_filter.RULES + [(None, "/", "block")], "host string, path string, action string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages, rules).collect()}
    assert got == {i: rule_of(u) for i, u in rows}


def test_url_block_beats_allow_and_empty_inputs(spark):
    rules = spark.createDataFrame([("a.b", "/", "block"), ("A.b", "/", "allow")], "host string, path string, action string")
    pages = spark.createDataFrame([(1, "http://a.b/x")], "page_id int, url string")
    assert url_filter.filter_urls(pages, rules).first().verdict == "block"
    assert url_filter.filter_urls(pages, rules.limit(0)).first().verdict == "allow"
    assert url_filter.filter_urls(pages.limit(0), rules).count() == 0


# --- decontamination -----------------------------------------------------------------------

def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UP))


def brute_hits(text, items):
    w = words(text)
    hit, found = set(), set()
    for item, t in items:
        v = words(t)
        if item is None or not v:
            continue
        m = min(13, len(v))
        grams = {tuple(v[i:i + m]) for i in range(len(v) - m + 1)}
        for i in range(len(w) - m + 1):
            if tuple(w[i:i + m]) in grams:
                hit.update(range(i, i + m))
                found.add(item)
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()


ITEMS = [(1, " ".join(f"t{i}" for i in range(30))), (2, "one TWO"), (10, "solo"), (3, "a b a b a b a b a b a b a b a"),
         (4, None), (5, "!!"), (6, "one two"), (7, "über straße 12 Ünder")]
DOCS = [(1, "x " * 5 + " ".join(f"T{i}" for i in range(4, 22)) + " y"), (2, "one, two; ONE-two"), (3, None), (4, ""),
        (5, "a b " * 40), (6, "Solo"), (7, "über Straße 12 Ünder über straße 12 Ünder"), (8, "b a " * 6 + "b"),
        (9, "z " * 500 + "solo"), (9, "z " * 500 + "solo")]


@pytest.mark.parametrize("shard", [1, 10**9])
def test_decontamination_against_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", shard)
    docs = spark.createDataFrame([(i, t, 5) for i, t in DOCS], "doc_id int, text string, n_words int")
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    got = sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
                 for r in decontaminate.contamination(docs, items).collect())
    want = []
    for i, t in DOCS:
        n, hit, k, sha = brute_hits(t, ITEMS)
        want.append((i, n, hit, k, sha, hit > 0 and 20 * hit >= n))
    assert got == sorted(want)
    left = decontaminate.remove_contaminated(docs, items)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(w[0] for w in want if not w[5])


def test_decontamination_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id int, text string")
    items = spark.createDataFrame([], "item_id int, text string")
    r = decontaminate.contamination(docs, items).first()
    assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (2, 0, 0, False)
    assert decontaminate.contamination(docs.limit(0), items).count() == 0


# --- PII -----------------------------------------------------------------------------------

PRIVATE = ("Mail Anna.B@mail7.example.com or anna.b@mail7.example.com, call +1 (375) 555-4393, pay 4207051279108084 "
           "from 49.37.233.206, password=e3b3ed3cc8548923d6 token = \"0641917ea4e9feb9\". Frau Müller met Mr. John Smith "
           "and Госпожа Иванова.")


def test_pii_surrogates(spark):
    rows = [(1, PRIVATE, 7), (2, PRIVATE, 7), (3, "call +1 375 555 4393 now", 7), (4, "Clean text. 12 of 1999!", 7),
            (5, None, 7), (6, "", 7), (7, "card 8007782375593431 is none", 7)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, n int")
    got = {r.doc_id: r for r in pii.pseudonymise(docs, "k").collect()}
    new = got[1].text
    assert new == got[2].text and got[1].n == 7
    for secret in ("mail7", "555-4393", "4207051279108084", "49.37.233.206", "e3b3ed", "0641917", "Müller", "Smith", "Иванова"):
        assert secret not in new
    kinds = [k for _, _, k, _ in pii.detect(PRIVATE)]
    assert [k for _, _, k, _ in pii.detect(new)] == kinds and got[1]._entities == len(kinds) == 10
    phone = re.search(r"\+1 \((\d{3})\) (\d{3})-(\d{4})", new)
    assert "+1 " + " ".join(phone.groups()) in got[3].text  # the same entity in another format
    card = re.search(r"\b4\d{15}\b", new).group()
    assert pii.luhn(card)
    assert re.search(r"Госпожа [А-Я][а-я]+", new)
    assert re.search(r"Mr\. (" + "|".join(pii.NAMES["latin", "m"]) + ") ", new)
    for i in (4, 5, 6, 7):
        assert got[i].text == rows[i - 1][1] and got[i]._entities == 0
    assert pii.pseudonymise(docs.limit(0), "k").count() == 0


def test_pii_collisions_are_drawn_again(spark):
    # a closure travels to the workers by value; they cannot import this module
    def crowded(key, kind, entity, draw=0):
        """Few values, some of them real entities."""
        return f"1.1.1.{hashlib.sha256(f'{entity}/{draw}'.encode()).digest()[0]}"

    docs = spark.createDataFrame([(i, f"x 1.1.1.{i} y 1.1.1.{i}") for i in range(1, 40)], "doc_id int, text string")
    raw = b"k"
    draws = {(r.kind, r.entity): r.draw for r in pii.resolve(docs, raw, crowded).collect()}
    assert draws
    finals = [crowded(raw, "ip", f"1.1.1.{i}", draws.get(("ip", f"1.1.1.{i}"), 0)) for i in range(1, 40)]
    assert len(set(finals)) == 39
    assert not {f"1.1.1.{i}" for i in range(1, 40)} & set(finals)


def test_pii_people_keep_one_family_name(spark):
    texts = ["Mr. John Smith met Mrs. Smith. Mr. Smith left; Smith came back, and SMITH'S smithy too.",
             "Mrs. Smith wrote to Frau Smith-Jones and Mr. O'Neil of Smithfield.", "Mr. JOHN SMITH signed.",
             "Smith alone is nobody here.", "Mr. Иван Петров"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r for r in pii.pseudonymise(docs, "k").collect()}
    m = re.fullmatch(r"Mr\. (\w+) (\w+) met Mrs\. (\w+)\. Mr\. (\w+) left; (\w+) came back, and (\w+)'S smithy too\.", got[0].text)
    given, family, *again = m.groups()
    assert again == [family, family, family, family.upper()] and family != "Smith" and got[0]._entities == 5
    assert any(given.startswith(x) for x in pii.NAMES["latin", "m"])
    m = re.fullmatch(r"Mrs\. (\w+) wrote to Frau ([A-Z][a-z]+-[A-Z][a-z]+) and Mr\. (O'[A-Z][a-z]+) of Smithfield\.", got[1].text)
    assert m.group(1) == family and m.group(2) != "Smith-Jones" and m.group(3) != "O'Neil"
    assert got[2].text == f"Mr. {given.upper()} {family.upper()} signed."
    assert got[3].text == texts[3] and got[3]._entities == 0
    assert all("Ѐ" <= c <= "ӿ" for c in got[4].text[4:].replace(" ", ""))


def test_pii_domains_stay_distinct(spark):
    hosts = [f"{a}.org" for a in "abcdefghijklmnopqrstuvwxyz"] + [f"{a}.net" for a in "abc"]
    docs = spark.createDataFrame([(i, f"write to me@{h} or you@{h.upper()} now") for i, h in enumerate(hosts)], "doc_id int, text string")
    got = {r.doc_id: re.findall(r"(\S+)@(\S+)", r.text) for r in pii.pseudonymise(docs, "k").collect()}
    new = [got[i][0][1].lower() for i in range(len(hosts))]
    assert len(set(new)) == len(hosts) and not set(new) & set(hosts)
    assert all(got[i][1][1].lower() == new[i] and new[i].endswith(h[1:]) for i, h in enumerate(hosts))


def alphabetic(i, letters="abcdefghij"):
    return "".join(letters[int(c)] for c in f"{i:05d}")


def test_pii_space_grows_beyond_its_first_size(spark):
    """More titled surnames, short phone numbers, two-letter mail names and secrets than a first draw has values."""
    rows = [(i, f"Mr. S{alphabetic(i)} and Frau F{alphabetic(i)} spoke.") for i in range(6000)]
    rows += [(10**5 + i, f"call +1 {i // 100:02d} {i % 100:02d} now") for i in range(9990)]
    rows += [(2 * 10**5 + i, f"mail {chr(97 + i // 26)}{chr(97 + i % 26)}@x.org") for i in range(676)]
    rows += [(3 * 10**5 + i, f"token=________{i}") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    got = {r.doc_id: r.text for r in pii.pseudonymise(docs, "k").collect()}
    old, new = [{e for t in texts for _, _, k, e in pii.detect(t)} for texts in ([t for _, t in rows], got.values())]
    assert len(old) == 2 * 6000 + 9990 + 676 + 10
    assert len(new) == len(old) and not old & new
    assert re.fullmatch(r"Mr\. [A-Z][a-z]+ and Frau [A-Z][a-z]+ spoke\.", got[17])
    assert all(re.fullmatch(r"call \+1 \d\d \d{2,9} now", got[10**5 + i]) for i in range(9990))


@pytest.mark.parametrize("text, found", [
    ("pay 4111111111111111 123 now", ["4111111111111111"]),
    ("pay 4111 1111 1111 1111 12/27", ["4111 1111 1111 1111"]),
    ("2 4111111111111111", ["4111111111111111"]),
    ("no. 2-4111111111111111", ["4111111111111111"]),
    ("4111-1111-1111-1111-12345", ["4111-1111-1111-1111"]),
    ("1234 5678 9012 4111 1111 1111 1111", ["4111 1111 1111 1111"]),
    ("4111111111111111 5500005555555559", ["4111111111111111", "5500005555555559"]),
    ("2 375-555-4393 41", ["375-555-4393"]),
    ("8007782375593431 123 is none", []),
    ("password=correcthorsebattery", ["correcthorsebattery"]),
    ('token = "abcdefghij"', ["abcdefghij"]),
    ("token: alice-bob@example.com", ["alice-bob@example.com"]),
    ("secret: understanding", []),
])
def test_pii_beside_other_numbers_and_words(text, found):
    assert [e for *_, e in pii.detect(text)] == found


def test_pii_full_address_space_has_room():
    far = {pii.surrogate(b"k", "ip", "1.2.3.4", d) for d in range(20)}
    assert len(far) == 20 and sum(":" in a for a in far) == 20 - pii.SAME_LENGTH - 1
    assert len(pii.surrogate(b"k", "card", "4111111111111111", 10)) == 22
    assert all(pii.luhn(pii.surrogate(b"k", "card", "4111111111111111", d)) for d in range(12))


# --- fingerprints --------------------------------------------------------------------------

PIECE = re.compile(r"[^ \t\n\x0b\f\r]+(?:[ \t\x0b\f\r]+[^ \t\n\x0b\f\r]+){0,15}")


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def check_versions(rows, got):
    rows = sorted(rows, key=lambda r: r[0])
    for n, (i, t) in enumerate(rows):
        t, x = t or "", rows[(n + 1) % len(rows)][1] or ""
        k = len(t) // 4
        e = t[:len(t) - k] + x[:k]
        a, b, c = (set(PIECE.findall(v)) for v in (t, e, x))
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert r.near_edited == pytest.approx(likeness(a, b)) and r.near_next == pytest.approx(likeness(a, c))
        assert 0 <= r.near_edited <= 1 and (r.fingerprint == r.edited_fingerprint) == (a == b)


def test_fingerprints_against_sets(spark):
    long = "\n".join(f"line {i} " + " ".join(f"w{i * j % 97}" for j in range(30)) for i in range(150))
    rows = [(5, "a b c"), (1, None), (9, ""), (3, long), (4, long), (20, long.replace("w3", "é𝄞")), (7, "x" * 5000), (2, "Ä\n" * 30)]
    got = fingerprint.versions(spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, keys string"))
    got = {r.doc_id: r for r in got.collect()}
    check_versions(rows, got)
    assert got[3].fingerprint == got[4].fingerprint != got[20].fingerprint and got[3].near_next == 1


def test_fingerprint_corner_tables(spark):
    one = fingerprint.versions(spark.createDataFrame([(4, "a b c d")], "doc_id long, text string")).first()
    assert one.near_next == 1 and one.n_chars == 7
    assert fingerprint.versions(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = [(1, "a"), (1, "a"), (1, "b b"), (None, "c"), (2, "d d d d")]
    got = fingerprint.versions(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "1", "1", "2", "None"]


def test_fingerprint_query_sees_what_short_texts_share(spark, tmp_path):
    """Three quarters of a text of 16 words are equal after the edit: one of its pieces at least."""
    rows = [(i, " ".join(f"w{i}x{j:02d}" for j in range(16))) for i in range(6)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = fingerprint.op4_fingerprint(spark, str(tmp_path)).collect()
    assert [r.near_edited for r in got] == [pytest.approx(1 / 3)] * 6 and all(r.near_next == 0 for r in got)


def test_fingerprint_of_one_long_text_grows_with_its_keys(spark):
    """48,000 differing keys of one row; blocks gathered key by key copied each other for half a minute."""
    def took(n):
        keys = f"transform(sequence(1, cast(id as int)), i -> {fingerprint._key('xxhash64(i)', '1')})"
        began = time.time()
        got = spark.range(n, n + 1).selectExpr(f"{fingerprint._large(keys)} AS v").select("v.d", "v.bad").first()
        assert got.d + len(got.bad) == n and len({x.k for x in got.bad}) == len(got.bad) < n / 4
        return time.time() - began

    assert took(1) and took(200)  # warm
    assert took(48_000) < 10


def test_fingerprint_is_native(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    plan = fingerprint.versions(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- HTML ----------------------------------------------------------------------------------

def page(body, **more):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


PAGES = [
    ("<nav><a href=/>Home</a></nav><article><h1>Head &amp; line</h1><p><b>One\n two.<br>three<p>Four &#233;.</article>"
     "<footer>&copy; me</footer>", "Head & line\nOne two. three\nFour é."),
    ("<div class=menu>Menu here now</div><div id='content' class='post-12'><p>Main text is here. And more.</p>"
     "<ul><li>first<li>second</ul><script>var t='</p>';</script></div><div class='sidebar'>Side text of some length. Long."
     "</div><section class=comments><p>A reader says. Very much of it. " + "words " * 90 + "</p></section>",
     "Main text is here. And more.\nfirst\nsecond"),
    ("<main><section class=cookie-notice><p>We use cookies.</p></section><p>Body text. Yes.</p>"
     "<form><p>Name</p><input name=a></form><!-- ad --><aside>Also read this.</aside></main>", "Body text. Yes."),
    ("", ""),
    ("<p>Only &lt;this&gt;&nbsp;here.", "Only <this> here."),
]


def test_html_extraction(spark):
    rows = [(i, f"http://h{i}.com/a", page(b)) for i, (b, _) in enumerate(PAGES)] + [(90, None, None), (91, "x", "")]
    pages = spark.createDataFrame([(*r, "old") for r in rows], "page_id int, url string, html string, text string")
    got = {r.page_id: r for r in html_extract.extract_pages(pages).collect()}
    assert {i: r.text for i, r in got.items()} == {**{i: t for i, (_, t) in enumerate(PAGES)}, 90: "", 91: ""}
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert html_extract.extract_pages(pages.limit(0)).count() == 0


STORY = "<h1>Head</h1><p>A story of some length. It goes on.</p>"


@pytest.mark.parametrize("body, text", [
    (f"<div class='content has-sidebar'>{STORY}</div>", "Head\nA story of some length. It goes on."),
    (f"<div class='page no-header'>{STORY}</div>", "Head\nA story of some length. It goes on."),
    ("<article><div class='entry-header'><h1>Head</h1></div><p>Body text. Yes.</p></article>", "Head\nBody text. Yes."),
    (f"<section id='search-results'>{STORY}</section>", "Head\nA story of some length. It goes on."),
    ("<p class='related-work'>Related work. Much of it.</p>", "Related work. Much of it."),
    ("<p>See <a href='/hidden-gems'>the gems</a> here.</p>", "See the gems here."),
    (f"<div data-title='The hidden room' data-style='overflow:hidden'>{STORY}</div>", "Head\nA story of some length. It goes on."),
    (f"<div title='class=ad id=menu hidden'>{STORY}</div>", "Head\nA story of some length. It goes on."),
    (f"<div class='story-widget'>{STORY}</div><p>Tail.</p>", "Head\nA story of some length. It goes on.\nTail."),
    (f"<div class='search'>{STORY}</div>", "Head\nA story of some length. It goes on."),
    (f"<main>{STORY}<div class='site-footer'>We. Foot.</div><div hidden>H.</div><div class='widget-3'>W. W.</div><ul class='nav-links'><li>N</ul>"
     "<div style='color:red; display: none'>N.</div><div class='cookie-notice'>" + "Cookies. " * 90 + "</div></main>",
     "Head\nA story of some length. It goes on."),
])
def test_html_names_mark_only_what_they_name(body, text):
    assert html_extract.extract(page(body)) == text


def test_html_host_consensus_beats_a_page(spark):
    """A page whose aside-like block is longer than its story follows the path that its host votes for."""
    story = "<div class='story-{0}'><p>{1}</p></div><div class='extra'><p>{2}</p></div>"
    rows = [(i, "http://h.com/", page(story.format(i, "Good text. " * 30, "Short."))) for i in range(6)]
    rows.append((9, "http://h.com/", page(story.format(9, "Tiny. Story.", "Loud other text. " * 30))))
    got = {r.page_id: r.text for r in html_extract.extract_pages(
        spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    assert got[9] == "Tiny. Story."
