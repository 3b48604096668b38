"""Templates of hosts by counts alone: tags and classes of these pages tell nothing."""

from sluice.llm import html_text

SCHEMA = "page_id long, url string, html string"
WORDS = "amber basin cedar delta ember fjord grove heath islet jetty knoll larch marsh north ocean".split()


def prose(*numbers):
    return " ".join(WORDS[(n * 7 + k * k) % len(WORDS)] + str(n * 31 + k) for n in numbers for k in range(12))


def texts(spark, bodies):
    pages = spark.createDataFrame([(i, "http://h.example/x", b) for i, b in enumerate(bodies)], SCHEMA)
    return {r.page_id: r.text for r in html_text.main_texts(pages).collect()}


def test_counts_cut_parts_outside_the_article(spark):
    teaser = f"<div class='x1'><article><p>{prose(900)}</p></article></div>"
    own = [prose(*range(10 * i, 10 * i + 3)) for i in range(8)] + [f"Brief {i}." for i in range(2)]
    got = texts(spark, [f"<body>{teaser}<article><p>{t}</p></article></body>" for t in own])
    assert [got[i] for i in range(10)] == own  # the teaser is the longer article of the last two pages


def test_parts_of_no_article_are_cut(spark):
    around = "<div class='x2'><div>Home</div><div>All themes</div></div>%s<div class='x3'>Some firm of 1999</div>"
    got = texts(spark, [f"<body>{around % f'<p>{prose(i)}</p>'}</body>" for i in range(8)])
    assert all(got[i] == prose(i) for i in range(8))


def test_edited_copies_are_no_template(spark):
    def copy(i):
        return [prose(p) if p != i % 6 else prose(100 + i) for p in range(6)]

    for n in (6, 60):  # few and many copies with one paragraph edited in each
        got = texts(spark, ["<article>" + "".join(f"<p>{t}</p>" for t in copy(i)) + "</article>" for i in range(n)])
        assert all(got[i] == "\n".join(copy(i)) for i in range(n))


def test_weights_leave_the_part_out():
    lines, unit = [(1, 10), (2, 10), (3, 50)], html_text.UNIT
    got = html_text.page_weights(lines, [(7, 2, 3), (8, 0, 0)], {2: 4, 3: 9})
    assert got == {None: round(unit / 9), 7: unit, 8: round(unit / 9)}
    assert html_text.page_weights([(1, 5)], [(7, 0, 1)], {}) == {None: unit, 7: 0}
