"""Scalar functions against value tables and the standard library."""

import re
from urllib.parse import urldefrag, urljoin, urlparse

import pytest
from pyspark.sql import functions as F

from tallygraph.functions import keys, numbers, text, urls

URLS = ["HTTPS://A.B/x/#f", "http://a.b", "http://a.b/", "https://A.b:80/X/y/?q=1#z", "//c.d/e", "https://a.b/p;v=1/q;w=2?x",
        "https://user@Host.com:8080/a/", "mailto:x@y.z", "a/b", "https://a.b//x//", "  https://a.b/t", "https://a.b/?", "ftp://q/w"]
HREFS = ["/x", "x", "../x", "../../../x/./y/..", "?q=2", "#top", "//o.p/z", "https://c.d/e?f#g", "./", "..", "", "a//b", "/a//b/../c",
         "x/../../y?z=1#w", "http:rel", "javascript:void(0)", "/a;b=1"]
BASES = ["https://a.b/c/d", "https://a.b/c/d/", "https://a.b", "https://A.b/c;p?old=1", "http://a.b/1/2/3.html?x#y"]


def _normal(u):
    p = urlparse(urldefrag(u)[0])
    path = p.path or "/"
    if path != "/" and path.endswith("/"):
        path = path[:-1]
    return f"{p.scheme.lower() or 'https'}://{p.netloc.lower()}{path}{'?' + p.query if p.query else ''}"


def test_normalize_url(column):
    assert column(URLS, urls.normalize_url) == [_normal(u) for u in URLS]


def test_normalize_url_strict(column):
    cases = [" HTTP://A.b/x//#f ", "a.b/c", "https://a.b/?", "https://a.b/x y\tz", "", "https://a.b/?#q"]
    assert column(cases, urls.normalize_url_strict) == [
        "http://A.b/x", "https://a.b/c", "https://a.b/?", "https://a.b/xyz", "", "https://a.b"]


@pytest.mark.parametrize("base", BASES)
def test_resolve_link_as_urljoin(column, base):
    got = column(HREFS, lambda h: urls.normalize_url(urls.resolve_link(F.lit(base), h)))
    assert got == [_normal(urljoin(base, h)) for h in HREFS]


def test_domains(column):
    assert column(["a.co.uk", "WWW.x.com:80", "localhost", "", "a..b"], urls.reg_domain) == ["co.uk", "x.com", "localhost", "", ".b"]
    assert column(["www.x.com", "x", "www.a.b.c"], lambda h: urls.reg_domain(h, True)) == ["x.com", "x", "b.c"]
    assert column(["https://u:p@H.com:1/x", "x.y/z"], lambda u: urls.host(urls.with_scheme(u))) == ["h.com", "x.y"]


def test_sections_and_reasons(column):
    assert column(["https://a.b/", "https://a.b/News/1", "https://a.b/x-y"], urls.section_key) == ["home", "news", "x-y"]
    assert column(["https://a.b/login", "https://a.b/x.pdf", "https://t.me/x", "https://a.b/about", "https://a.b/Cart/login"],
                  urls.ignore_reason) == ["login", "file", "social", None, "login"]


def test_human_number(column):
    table = {"1.2M": 1200000, "1,2 млн": 1200000, "12.3K": 12300, "2.5 тис.": 2500, "1 234": 1234, "12.5": 125, "abc": None,
             "1\xa0234": 1234, "3 billion": 3000000000, "1,234 subscribers": 1234, "": None, "0.5k": 500}
    assert column(list(table), numbers.human_number) == list(table.values())


def test_money_number(column):
    table = {"4 780 594 950,00": 4780594950.0, "1 234 567,89": 1234567.89, "1,234,567.89": 1234567.89, "1.234.567,89": 1234567.89,
             "1,234,567": None, "грн": None, "12.": 12.0}
    assert column(list(table), numbers.money_number) == list(table.values())


def test_installs_and_sizes(spark, column):
    assert column(["10,000,000+", "1B+", "5 К", "2Т", "x"], numbers.installs_number) == [10000000, 1000000000, 5000, 2000000000, None]
    rows = spark.createDataFrame([("1.2", "GB"), ("512", "КБ"), ("3,5", "mb"), ("1", "xx")], "n string, u string")
    assert [r[0] for r in rows.select(numbers.size_to_bytes(F.col("n"), F.col("u"))).collect()] == [1288490189, 524288, 3670016, None]
    assert column([160731136, 1310720, 2 ** 31], numbers.human_size, "bigint") == ["153.3 MB", "1.2 MB", "2.00 GB"]


def test_dates(column):
    assert column(["Jun 30, 2026", "30 черв. 2026", "31 feb 2020", "32 may 2020", "nothing"],
                  lambda c: numbers.month_name_date(c)["ymd"]) == [20260630, 20260630, 20200231, None, None]
    assert column(["2026-07-04T10:00:00Z", "July 2026 now"], lambda c: numbers.iso_date(c)["iso"]) == ["2026-07-04", "July 2026 "]
    assert column(["2026-07-04T10:00:00Z", "2026-7-4", "04.07.2026", "2026-07-04 10:00:00", "x"],
                  lambda c: F.date_format(numbers.flex_date(c), "yyyy-MM-dd HH")) == [
        "2026-07-04 10", "2026-07-04 00", "2026-07-04 00", "2026-07-04 10", None]


def _indices(total, k):
    if total <= k:
        return list(range(total))
    head = tail = max(1, k // 3)
    mid = k - head - tail
    step = (total - head - tail) / float(mid + 1) if mid > 0 else 0
    spread = [head + int(round(step * i)) for i in range(1, mid + 1)]
    out = []
    for i in [*range(head), *spread, *range(total - tail, total)]:
        if 0 <= i < total and i not in out:
            out.append(i)
    return out


@pytest.mark.parametrize("k", [1, 2, 3, 5, 6, 60])
def test_sample_indices(column, k):
    totals = [0, 1, 3, 5, 10, 61, 100, 99999]
    assert column(totals, lambda c: numbers.sample_indices(c, k), "bigint") == [_indices(t, k) for t in totals]


def test_keys(column):
    assert column(["Склады", "Прочее", "Клиенты"], lambda t: keys.canon_class(F.lit("ref"), t)) == ["warehouses", "catalogs", "counterparties"]
    assert column(["Склады"], lambda t: keys.canon_class(F.lit("doc"), t)) == ["documents"]
    assert column(["{1,ааа,Товары и услуги}", "xx"], keys.first_human_name) == ["Товары и услуги", None]
    assert column(["Іваненко Петро", "іваненко Петро", "A B", "Іваненко Петро Частка", "One Two Three Four Five"], keys.is_person_name) == [
        True, False, False, False, False]
    assert column(["My  Shop!"], lambda n: keys.namespaced_ref(n, F.lit("c1-1"))) == ["twin_my_shop__c1-1"]


def test_row_ref(spark):
    rows = spark.createDataFrame([("7", 7, b"\x01" * 16, 3), ("", 0, b"\x01" * 16, 3), (None, None, None, 3), ("0", 1, None, 3)],
                                 "s string, n int, id binary, ri bigint")
    by_text = rows.select(keys.row_ref("c1", F.col("s"), "string", F.col("id"), F.col("ri")).alias("r")).collect()
    by_number = rows.select(keys.row_ref("c1", F.col("n"), "integer", F.col("id"), F.col("ri")).alias("r")).collect()
    assert [r.r for r in by_text] == ["c1-7", "c1-" + "01" * 16, "c1-r3", "c1-0"]
    assert [r.r for r in by_number] == ["c1-7", "c1-" + "01" * 16, "c1-r3", "c1-1"]


def test_markup(column):
    page = ('<html lang="uk-UA"><head><title>\n A &amp;\xa0 B </title><meta content="T" property="og:title"></head>'
            '<script>var t="</p>";</script><!-- c --><p>one<br>two</p><style>x{}</style></html>')
    assert column([page], text.title) == ["A &amp; B"]
    assert column([page], text.clean_text) == ["A &amp; B one two"]
    assert column([page], lambda h: text.clean_text(h, decode=True)) == ["A & B one two"]
    assert column([page], text.page_lang) == ["uk"]
    assert column([page], lambda h: text.meta_property(h, "og:title")) == ["T"]
    assert column(["&amp;lt; &quot;x&quot;"], text.unescape) == ['< "x"']
    long = "".join(chr(97 + i % 26) for i in range(3000))
    (cut,) = column([long], lambda t: text.head_and_tail(t, 1000))
    assert cut.startswith(long[:600]) and cut.endswith(long[-350:]) and re.search("ПРОПУЩЕНО", cut)
