import pytest

from cairn.llm import markup as m

CASES = [
    ("<p>The <b>stem</b> &amp; leaf</p>", "The stem & leaf"),
    ("<ul><li>one<li>two <i>x</i></ul>", "- one\n- two x"),
    ("<ol><li>a</li><li>b<ul><li>c</ul></ol>", "1. a\n2. b\n  - c"),
    ("<table><tr><td>node<td>81<TR><TD>token<TD>rigid</table>", "node   81\ntoken  rigid"),
    ("|op|state|\n|:--|--:|\n|[a\\_b](#x)|warm|", "op   state\na_b  warm"),
    ('{| class="w"\n|-\n! a !! bb\n|-\n| ccc || d\n|}', "a    bb\nccc  d"),
    ("a<!-- gone -->b", "ab"),
    ('x<script>alert("1")</script><span style="display: none">no</span><p hidden>no</p>y', "xy"),
    ("<h2>Head</h2>text", "Head\n\ntext"),
    ("== Head ==\ntext '''bold''' [[Page|shown]] {{Note|a|k=2}}", "Head\n\ntext bold shown a"),
    ("\\section{Head}\\label{s}\n\\textbf{b} \\emph{e}~\\cite[p.~3]{k1} \\ref{f:x}", "Head\n\nb e [k1, p. 3] (f:x)"),
    ("\\begin{itemize}\n\\item a\n\\item b\n\\end{itemize}", "- a\n- b"),
    ("\\begin{equation}\nx_{1} = 2\n\\end{equation}", "$$x_{1} = 2$$"),
    ("\\[ x^2 = 4 \\]", "$$x^2 = 4$$"),
    ("**b** *i* ***bi*** ~~s~~ __two words__ _it_", "b i bi s two words it"),
    ("[t](u) ![alt](v) <https://a.b/c>", "t alt https://a.b/c"),
    ("# Title\nbody[^1]\n\n[^1]: note\n[r]: https://x.y", "Title\n\nbody[1]\n\n[1] note"),
    ("> quoted", "quoted"),
    ("Title\n=====\nx", "Title\n\nx"),
    ("<pre><code class=\"language-py\">if a &lt; b:\n    c()</code></pre>", "```py\nif a < b:\n    c()\n```"),
    ("<math><msub><mi>r</mi><mn>1</mn></msub><mo>=</mo><mn>9</mn></math>", "$r_{1} = 9$"),
    ("a&nbsp;b &#8212; &#x2013; c", "a\u00a0b \u2014 \u2013 c"),
    ("\\<a\\> \\*b\\*", "<a> *b*"),
    ("<dl><dt>t<dd>d</dl>", "t\n\n  d"),
    ("cell<ref name=\"s\">src, p. 2</ref> is", "cell (src, p. 2) is"),
    ("<details><summary>S</summary>body</details>", "S\nbody"),
]

PLAIN = [
    "The check is a < 36 and b > 25.",
    "Q&A, R&D and I/O share one.",
    "A box of 5 * 6 * 8 mm holds a_b_c and x_id.",
    "It costs $5 or $7 per warp, see item [3] and issue #7306.",
    "Here {texture} is a placeholder.",
    "Files end in ~a or in .b~ now.",
    "The __init__ hook runs before __call__ does.",
    "Put it under C:\\cone\\shade\\texts on that machine.",
    "cache -> bridge -> sharp, i.e. 8 | 5 in the log.",
    "The type `Grid<Stage>` is not `Grid<Crease&>`. Pass `*args` and `**kwargs`; `h[b](c)`.",
    "- a\n* b\n+ c\n1. d\n  - e",
    "```xml\n<b>x</b> &amp; [x](y)\n```\ntext",
    "~~~\n**lattice** = '''dense'''",
    "The energy is $E_{c} = \\frac{6}{2} k x^2$ per cell.\n$$\\sum_i w_i$$",
    "List<Item> of T",
    "",
    "   ",
    "\U0001f9f5a \U0001d499b",
]


@pytest.mark.parametrize("text,clean", CASES, ids=[c[0][:24] for c in CASES])
def test_markup(text, clean):
    out, found = m.render(text)
    assert found > 0 and out == clean


@pytest.mark.parametrize("text", PLAIN, ids=[p[:24] for p in PLAIN])
def test_not_markup(text):
    out, found = m.render(text)
    assert found == 0 and out == text.strip()


@pytest.mark.parametrize("text,clean", [("How to ##", "How to"), ("Notes {#arc-6}", "Notes"), ("**Bold**", "Bold"), ('<a name="x"></a>Head', "Head"), ("T <sup>new</sup>", "T new")])
def test_titles(text, clean):
    assert m.render(text, True) == (clean, m.render(text, True)[1]) and m.render(text, True)[1] > 0
    assert m.render("Step #7: in C++ (x < 4)", True)[1] == 0


def test_long_emphasis_between_underscores():
    long = "Nothing in the right sweep depends on the sheet, so it is safe to leave it. " * 4 + "End."
    assert m.render(f"Note: _{long}_ Next.") == (f"Note: {long} Next.", 1)
    assert m.render("Note: _over two\nlines_ here.")[1] == 1
    for plain in (f"Note: _{long}\n\n{long}_ Next.", f"a _{long}\n- {long}_ b", f"a_{long}_b", f"the _{long} _ b"):
        assert m.render(plain)[1] == 0, plain
    m.render("_a " * 100_000)
    m.render("_" + "a " * 300_000)


def test_rendering_again_finds_nothing():
    for text, clean in CASES:
        if "\\*" not in text:
            assert m.render(clean)[1] == 0, clean


def test_broken_and_long_input_ends():
    for t in ("<" * 5000, "[" * 3000, "`" * 3001, "**" * 2000, "{{" * 2000, "<div>" * 900, "$" * 999, "\\" * 1000, "<table><tr>" * 300, "_a" * 2000, "|" * 2000, "\ufdd0\ufdd1" * 10, "<pre>" * 5000, "<code>x" * 5000, "<!-- " * 5000, "\\begin{equation}" * 500, "[a](" * 3000, "`a ``b " * 3000):
        m.render(t)
    assert len(m.render("word **b** " * 20000)[0]) == len("word b " * 20000) - 1


def test_no_cap_on_nesting():
    assert m.render("{{a|" * 50 + "x" + "}}" * 50) == ("x", 50)
    assert m.render("\\emph{a " * 50 + "x" + "}" * 50) == ("a " * 50 + "x", 50)
    assert m.render("[" * 50 + "a" + "](u)" * 50) == ("a", 50)
    assert m.render("<div>" * 500 + "x" + "</div>" * 500) == ("x", 1000)
    assert m.render("<ul><li>" * 150 + "x")[0].split() == ["-"] * 150 + ["x"]
    deep = "<mi>r</mi>"
    for _ in range(50):
        deep = f"<msub><mrow>{deep}</mrow><mn>1</mn></msub>"
    assert m.render(f"<math>{deep}</math>")[0] == "$r" + "_{1}" * 50 + "$"
    long = "nothing in the sweep depends on it " * 300
    for mark in ("_", "*", "**"):
        assert m.render(f"Note: {mark}{long.strip()}{mark} Next.") == (f"Note: {long.strip()} Next.", 1)
    # what isn't closed in its line, or at all, stays
    for plain in ("{{a|{{b", "a}} {{", "\\emph{a\nb}", "[a\n](u)", "x] [y"):
        assert m.render(plain)[1] == 0, plain


def test_time_is_linear_in_tags():
    import time

    def took(text):
        began = time.process_time()
        m.render(text)
        return time.process_time() - began

    for unit in ("a<b> x ", "<div>", "<p>x", "{{a|", "\\emph{", "[a](u) [", "<b>x</i>", "</p><div>"):
        small, large = min(took(unit * 4000) for _ in range(3)), took(unit * 16000)
        assert large < 12 * small + 0.3, (unit, small, large)


def test_operator(spark):
    rows = [(1, "**b**", ["a", None, "x ##"], "k"), (2, None, None, "k"), (3, " ", [], "k"), (4, "plain", ["C++"], "k"), (4, "plain", ["C++"], "k")]
    df = spark.createDataFrame(rows, "rec_id bigint, section_text string, heading_path array<string>, found string")
    assert sorted((r.rec_id, r.field) for r in m.marked_fields(df).collect()) == [(1, "heading_path"), (1, "section_text")]
    got = {r.rec_id: r for r in m.clean_sections(df).collect()}
    assert got[1].heading_path == ["a", None, "x"] and got[2].section_text is None and got[3].section_text == ""
    assert m.clean_sections(df).count() == 5 and m.marked_fields(df.limit(0)).count() == 0
