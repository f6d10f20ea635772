"""Element navigation over raw pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.functions.html import Tree, attr
from lexmill.operators import elements as E
from lexmill.functions.text import first_int, strip
from lexmill.session import new_path
from lexmill.streaming.intake import intake
from queries.inputs import SPACE
from queries.registry import query, table

T = Tree()

# The element table in SQL, on its own terms: tags are paired per name by their running level, then cut at the end of
# every element around them. `els(page_id, idx, pos, tag, mark, endp, stop, parent)`, `tok(page_id, pos, txt)`.
ELS = """WITH src AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'),
  '(?is)<(script|style)[^>]*>.*?</(script|style)>', '<\\1>', 'g'), '<![^>]*>', '', 'g') AS h FROM pages),
lst AS (SELECT page_id, regexp_extract_all(h, '<[^>]*>[^<]*') AS l FROM src),
tok AS (SELECT page_id, pos, t, lower(regexp_extract(t, '^</?([a-zA-Z][^\\s/>]*)', 1)) AS tag, t LIKE '</%' AS closing,
  replace(replace(replace(replace(regexp_extract(t, '(?s)^<[^>]*>(.*)$', 1), '&middot;', '·'), '&copy;', '©'),
  '&quot;', '"'), '&amp;', '&') AS txt, regexp_extract(t, '^<[^>]*>') AS mark
  FROM (SELECT page_id, unnest(l) AS t, generate_subscripts(l, 1) AS pos FROM lst)),
lv AS (SELECT *, sum(CASE WHEN closing THEN -1 ELSE 1 END) OVER (PARTITION BY page_id, tag ORDER BY pos) +
  CASE WHEN closing THEN 1 ELSE 0 END AS level FROM tok WHERE tag NOT IN ('br', 'meta', 'script', 'style')),
pr AS (SELECT page_id, pos, closing, lead(pos) OVER (PARTITION BY page_id, tag, level ORDER BY pos) AS nxt FROM lv),
lastp AS (SELECT page_id, max(pos) + 1 AS n FROM tok GROUP BY 1),
op AS (SELECT t.page_id, t.pos, t.tag, t.mark, row_number() OVER (PARTITION BY t.page_id ORDER BY t.pos) - 1 AS idx,
  CASE WHEN t.tag IN ('br', 'meta', 'script', 'style') THEN t.pos ELSE coalesce(pr.nxt, n) END AS raw
  FROM tok t JOIN lastp USING (page_id) LEFT JOIN pr ON pr.page_id = t.page_id AND pr.pos = t.pos WHERE NOT t.closing),
ends AS (SELECT e.page_id, e.pos, least(any_value(e.raw), coalesce(min(a.raw), any_value(e.raw))) AS endp FROM op e
  LEFT JOIN op a ON a.page_id = e.page_id AND a.pos < e.pos AND a.raw > e.pos GROUP BY 1, 2),
sp AS (SELECT op.page_id, op.pos, idx, tag, mark, endp FROM op JOIN ends USING (page_id, pos)),
els AS (SELECT e.*, (SELECT coalesce(max(a.idx), -1) FROM sp a WHERE a.page_id = e.page_id AND a.pos < e.pos
    AND a.endp > e.pos) AS parent,
  (SELECT count(*) FROM sp b WHERE b.page_id = e.page_id AND b.pos < greatest(e.endp, e.pos + 1)) AS stop FROM sp e)
"""
TEXT = """, textof AS (SELECT e.page_id, e.idx, coalesce(string_agg(t.txt, '' ORDER BY t.pos), '') AS text,
  count(*) FILTER (WHERE t.txt <> '') AS pieces FROM els e LEFT JOIN tok t ON t.page_id = e.page_id AND t.pos >= e.pos
  AND t.pos < e.endp GROUP BY 1, 2)
"""


def pages(spark, d):
    return table(spark, d, "pages")


def trees(spark, d):
    return E.with_tree(pages(spark, d).select("page_id", "html"))


@query("H1_elements", ELS + """SELECT page_id, CAST(idx AS INTEGER) AS idx, tag, mark AS markup, CAST(parent AS INTEGER)
    AS parent, CAST(stop AS INTEGER) AS stop FROM els WHERE tag NOT IN ('script', 'style')""")
def _(spark, d):
    els = E.elements(pages(spark, d), "page_id")
    return els.where("tag not in ('script', 'style')").select("page_id", "idx", "tag", "markup", "parent", "stop")


@query("H2_find_all", ELS + TEXT + """SELECT page_id, CAST(idx AS INTEGER) AS idx, md5(text) AS t FROM els JOIN textof
    USING (page_id, idx) WHERE (tag = 'div' AND mark LIKE '%class="ad"%') OR (tag = 'a' AND regexp_matches(mark,
    'href="/[a-m]'))""")
def _(spark, d):
    ads = E.matches(trees(spark, d), "page_id", name="div", cls="ad")
    links = E.matches(trees(spark, d), "page_id", name="a", href_re="^/[a-m]")
    return ads.unionByName(links).select("page_id", "idx", F.md5("text").alias("t"))


@query("H3_sole_string", ELS + TEXT + """, deep AS (SELECT e.page_id, e.idx, e.pos, text, pieces, stop - e.idx - 1 AS below
    FROM els e JOIN textof USING (page_id, idx) WHERE tag IN ('li', 'p', 'h1', 'ul', 'article', 'footer'))
  SELECT page_id, CAST(idx AS INTEGER) AS idx, md5(CASE WHEN text <> '' AND pieces = 1 AND (below = 0 OR (
    SELECT bool_and(x.pos = d.pos + x.idx - d.idx AND x.endp > d.pos + d.below) FROM els x WHERE x.page_id = d.page_id
      AND x.idx > d.idx AND x.idx <= d.idx + d.below) AND (SELECT txt FROM tok WHERE tok.page_id = d.page_id AND
      tok.pos = d.pos + d.below) = text) THEN text END) AS t FROM deep d""")
def _(spark, d):
    found = E.matches(trees(spark, d), "page_id", name=["li", "p", "h1", "ul", "article", "footer"])
    return found.select("page_id", "idx", F.md5("string").alias("t"))


@query("H4_find_next", ELS + """SELECT page_id, CAST(idx AS INTEGER) AS idx, CAST((SELECT min(b.idx) FROM els b WHERE
    b.page_id = a.page_id AND b.tag = 'p' AND b.idx > a.idx) AS INTEGER) AS next_p FROM els a""")
def _(spark, d):
    els = E.elements(pages(spark, d), "page_id")
    return E.nearest(els, "page_id", F.col("tag") == "p", "next_p", later=True).select("page_id", "idx", "next_p")


@query("H4_heading_to_paragraph", ELS + TEXT + """SELECT page_id, md5(text) AS t FROM (SELECT a.page_id, (SELECT min(b.idx)
    FROM els b WHERE b.page_id = a.page_id AND b.tag = 'p' AND b.idx > a.idx) AS idx FROM els a WHERE tag = 'h1') JOIN textof
    USING (page_id, idx)""")
def _(spark, d):
    return trees(spark, d).select("page_id", F.md5(T.text(T.next(T.find(name="h1"), name="p"))).alias("t"))


@query("H5_find_previous", ELS + """SELECT page_id, CAST(idx AS INTEGER) AS idx, CAST((SELECT max(b.idx) FROM els b WHERE
    b.page_id = a.page_id AND b.tag = 'p' AND b.idx < a.idx) AS INTEGER) AS last_p FROM els a""")
def _(spark, d):
    els = E.elements(pages(spark, d), "page_id")
    return E.nearest(els, "page_id", F.col("tag") == "p", "last_p", later=False).select("page_id", "idx", "last_p")


@query("H5_footer_to_paragraph", ELS + """SELECT page_id, CAST(idx AS INTEGER) AS idx, CAST((SELECT max(b.idx) FROM els b
    WHERE b.page_id = a.page_id AND b.tag = 'p' AND b.idx < a.idx) AS INTEGER) AS other_idx FROM els a
    WHERE tag = 'footer'""")
def _(spark, d):
    return E.paired(trees(spark, d), "page_id", {"name": "footer"}, lambda e: T.previous(e, name="p"))


@query("H6_next_sibling", ELS + """SELECT page_id, CAST(idx AS INTEGER) AS idx, CAST((SELECT min(b.idx) FROM els b WHERE
    b.page_id = a.page_id AND b.parent = a.parent AND b.tag IN ('li', 'div', 'p') AND b.idx > a.idx) AS INTEGER)
    AS other_idx FROM els a WHERE tag IN ('li', 'nav', 'p', 'h1')""")
def _(spark, d):
    return E.paired(trees(spark, d), "page_id", {"name": ["li", "nav", "p", "h1"]},
                    lambda e: T.sibling(e, name=["li", "div", "p"]))


@query("H7_ancestors", ELS + """SELECT a.page_id, CAST(a.idx AS INTEGER) AS idx, CAST(b.parent AS INTEGER) AS other_idx
    FROM els a JOIN els b ON a.page_id = b.page_id AND a.parent = b.idx WHERE a.tag = 'a'""")
def _(spark, d):
    return E.paired(trees(spark, d), "page_id", {"name": "a"}, lambda e: T.parent(e, 2))


@query("H8_descendants", ELS + """SELECT a.page_id, a.tag, CAST(count(b.idx) AS INTEGER) AS n FROM els a LEFT JOIN els b ON
    a.page_id = b.page_id AND b.tag IN ('a', 'b') AND b.pos > a.pos AND b.pos < a.endp WHERE a.tag IN ('nav', 'article')
    GROUP BY 1, 2""")
def _(spark, d):
    counts = F.transform(T.find_all(name=["nav", "article"]), lambda e: F.struct(
        e["tag"].alias("tag"), F.size(T.find_all(e, name=["a", "b"])).alias("n")))
    return trees(spark, d).select("page_id", F.inline(counts))


@query("H9_text", ELS + TEXT + """SELECT page_id, CAST(idx AS INTEGER) AS idx, md5(text) AS t, CAST(length(text) AS INTEGER)
    AS n FROM els JOIN textof USING (page_id, idx) WHERE tag IN ('article', 'footer', 'body', 'p')""")
def _(spark, d):
    found = E.matches(trees(spark, d), "page_id", name=["article", "footer", "body", "p"])
    return found.select("page_id", "idx", F.md5("text").alias("t"), F.length("text").alias("n"))


@query("H10_attributes", ELS + """SELECT page_id, CAST(idx AS INTEGER) AS idx, nullif(regexp_extract(mark,
    'href="([^"]*)"', 1), '') AS href, nullif(regexp_extract(mark, 'lang="([^"]*)"', 1), '') AS lang FROM els
    WHERE tag IN ('a', 'html', 'p')""")
def _(spark, d):
    found = F.transform(T.find_all(name=["a", "html", "p"]), lambda e: F.struct(
        e["idx"].alias("idx"), attr(e, "href").alias("href"), attr(e, "lang").alias("lang")))
    return trees(spark, d).select("page_id", F.inline(found))


def order_tables(spark, d):
    """One page per line item with a two-row table."""
    return table(spark, d, "lineitem").selectExpr(
        "concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS id",
        "concat('<table><tr><th>h</th></tr><tr data-href=\"/a/', l_partkey, '\"><td>', l_orderkey, '</td><td><b>', "
        "l_partkey, '</b></td><td>x</td></tr><tr><td>', l_suppkey, '</td></tr></table>') AS html")


@query("H11_table_cells", """SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id,
    '' || l_orderkey AS first, '' || l_partkey AS second, '/a/' || l_partkey AS row_attr FROM lineitem UNION ALL
    SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey, '' || l_suppkey, NULL, NULL
    FROM lineitem UNION ALL SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey, NULL, NULL,
    NULL FROM lineitem""")
def _(spark, d):
    return E.table_cells(E.with_tree(order_tables(spark, d)), "id", {"first": 0, "second": 1}, "data-href")


@query("H12_first_container", ELS + TEXT + """SELECT page_id, md5(coalesce((SELECT text FROM textof t WHERE t.page_id =
    p.page_id AND t.idx = (SELECT min(idx) FROM els e WHERE e.page_id = p.page_id AND tag = 'div' AND mark LIKE '%"ad"%')),
    (SELECT text FROM textof t WHERE t.page_id = p.page_id AND t.idx = (SELECT min(idx) FROM els e WHERE e.page_id =
    p.page_id AND tag = 'article')))) AS t FROM pages p""")
def _(spark, d):
    box = F.coalesce(T.find(name="iframe", id="doc"), T.find(name="div", cls="ad"), T.find(name="article"))
    return trees(spark, d).select("page_id", F.md5(T.text(box)).alias("t"))


LINES = """WITH broken AS (SELECT page_id, replace(replace(html, '<p>', chr(10) || '<p>'), '<footer>', chr(10) || chr(10) ||
  '<footer>') AS h FROM pages)
"""


def broken_pages(spark, d):
    return pages(spark, d).select("page_id", F.expr(
        "replace(replace(html, '<p>', '\\n<p>'), '<footer>', '\\n\\n<footer>')").alias("html"))


@query("H13_source_line", LINES + """SELECT page_id, CAST(1 + length(split_part(h, '<footer>', 1)) -
    length(replace(split_part(h, '<footer>', 1), chr(10), '')) AS INTEGER) AS footer_line,
    CAST(1 + length(split_part(h, '<h1>', 1)) - length(replace(split_part(h, '<h1>', 1), chr(10), '')) AS INTEGER)
    AS h1_line FROM broken""")
def _(spark, d):
    return E.with_tree(broken_pages(spark, d)).select(
        "page_id", T.line(T.find(name="footer")).alias("footer_line"), T.line(T.find(name="h1")).alias("h1_line"))


@query("W6_late_elements", LINES + """SELECT page_id, (length(split_part(h, '<b>', 1)) - length(replace(split_part(h,
    '<b>', 1), chr(10), '')) + 1) > 0.65 * (length(h) - length(replace(h, chr(10), ''))) AS late FROM broken
    WHERE contains(h, '<b>')""")
def _(spark, d):
    from lexmill.plans.common import parsed
    found = parsed(broken_pages(spark, d)).withColumn("b", T.find(name="b")).where("b is not null")
    return found.select("page_id", (T.line(F.col("b")) > F.col("page_lines") * 0.65).alias("late"))


@query("A8_sum_of_first_integers", """SELECT page_id, CAST(coalesce(list_sum(list_transform(list_filter(
    regexp_extract_all(html, '<p>[^<]*'), lambda p: regexp_matches(p, '[0-9]')),
    lambda p: TRY_CAST(regexp_extract(p, '[0-9]+') AS BIGINT))), 0) AS BIGINT) AS n FROM pages""")
def _(spark, d):
    own = F.transform(T.find_all(name="p"), lambda p: first_int(F.get(T.texts, p["pos"])))
    total = F.aggregate(own, F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return trees(spark, d).select("page_id", total.alias("n"))


@query("A9_blocks_per_page", """SELECT page_id, CAST(len(regexp_extract_all(html, '<div class="ad">')) AS INTEGER) AS ads,
    CAST(len(regexp_extract_all(html, '<li>')) AS INTEGER) AS items FROM pages""")
def _(spark, d):
    nav = T.find_all(name="nav")
    items = F.aggregate(F.transform(nav, lambda n: F.size(T.find_all(n, name="li"))), F.lit(0), lambda a, x: a + x)
    return trees(spark, d).select("page_id", F.size(T.find_all(name="div", cls="ad")).alias("ads"), items.alias("items"))


@query("A10_labels_under_heading", ELS + """, hit AS (SELECT t.page_id, t.pos, (SELECT max(e.idx) FROM els e WHERE
    e.page_id = t.page_id AND e.pos <= t.pos AND e.tag IN ('nav', 'article', 'footer', 'title')) AS near FROM tok t
    WHERE regexp_matches(txt, 'the|der') AND tag NOT IN ('script', 'style'))
  SELECT hit.page_id, CAST(count(*) FILTER (WHERE e.tag = 'article') AS INTEGER) AS n FROM hit LEFT JOIN els e ON
    e.page_id = hit.page_id AND e.idx = near GROUP BY 1""")
def _(spark, d):
    near = lambda p: F.try_element_at(F.filter(T.els, lambda e: (e["pos"] <= p) & e["tag"].isin(
        "nav", "article", "footer", "title")), F.lit(-1))
    found = T.text_nodes("the|der")
    hits = F.filter(found, lambda p: near(p)["tag"] == "article")
    return trees(spark, d).where(F.size(found) > 0).select("page_id", F.size(hits).alias("n"))


@query("A12_ordered_concat", f"""SELECT page_id, md5(array_to_string(list_transform(regexp_extract_all(html,
    '<li><a[^>]*>([^<]*)', 1), lambda x: regexp_replace(replace(x, '&amp;', '&'), '^[{SPACE}]+|[{SPACE}]+$', '', 'g')), ' - ')
    ) AS t FROM pages""")
def _(spark, d):
    items = F.transform(T.texts_of(T.find_all(name="li")), strip)
    return trees(spark, d).select("page_id", F.md5(F.array_join(items, " - ")).alias("t"))




@query("J1_streaming_intake", """SELECT url AS bill_page_url, md5(replace(replace(regexp_extract(html, '<title>([^<]*)', 1),
    '&quot;', '"'), '&amp;', '&')) AS bill_title FROM pages""")
def _(spark, d):
    source, stored, state = (new_path(spark, n) for n in ("pages", "records", "state"))
    rows = pages(spark, d).selectExpr("'X' AS country", "url", "'main' AS kind", "html")
    fields = "bill_page_url string, bill_title string"

    def extract(batch, stored_rows):
        titles = E.with_tree(batch).select(F.col("url").alias("bill_page_url"), T.text(T.find(name="title")).alias("t"))
        return titles.select("bill_page_url", F.md5("t").alias("bill_title"))

    for _ in range(2):  # the second delivery repeats every page and adds nothing
        rows.write.mode("append").parquet(source)
        intake(spark, source, stored, state, extract, fields).awaitTermination()
    return spark.read.schema(fields).parquet(stored)
