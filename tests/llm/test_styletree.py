
from transitlens.llm import styletree as S

SCHEMA = "page_id long, url string, html string, text string"


def text_of(page):
    return "\n".join(b[0] for b in S.usable(S.parse(page)))


def test_article_only_with_unclosed_and_misnested_elements():
    page = ('<html><head><title>x</title><script>var t="</p>";</script></head><body><nav><ul><li>Menu</li></ul></nav>'
            '<!-- ad 3 --><div class="ad">Buy</div><article><h1>Head  line</h1><p><b>First &amp; best.<br>'
            '<p>Second\n part.</p></article><footer>&copy; x</footer>')
    assert text_of(page) == "Head line\nFirst & best.\nSecond part."


def test_noise_inside_and_outside_the_article():
    page = ('<body><header>Site</header><aside>Side</aside><form><input>Sign up</form>'
            '<main><header><h1>T</h1></header><p>A</p><div class="share-links">Share</div>'
            '<section id="comments"><p>First!</p></section><div hidden>no</div><footer>by me</footer></main></body>')
    assert text_of(page) == "T\nA"


def test_unclosed_head_and_heading_classes():
    assert text_of("<html><head><title>x</title><meta charset='utf-8'><body><p>kept") == "kept"
    assert text_of("<article><h1 class='entry-header'>T</h1><p>x</article>") == "T\nx"


def test_odd_pages():
    assert text_of("") == "" and text_of("   ") == ""
    assert text_of("just text &lt;b&gt; 1 < 2") == "just text <b> 1 < 2"
    assert text_of("<p>open <b") == "open"
    assert text_of("<div>" * 3000 + "deep") == "deep"
    assert text_of("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>") == "a\nb\nc\nd"
    assert text_of("<p>a<script>x") == "a"
    assert text_of("<p>" + "word " * 50000) == " ".join(["word"] * 50000)


def test_template_parts_without_marks_are_found_by_the_tree(spark):
    rows = [(i, "http://h.example/x", f"<div class='top'>Same line</div><div class='story'><p>Story {i} tells {i * 7}.</p>"
             "</div><div class='low'>Powered by us</div>", "clash") for i in range(30)]
    rows += [(100, "http://single.example/", "<div class='top'>Same line</div><p>Only page</p>", None),
             (101, None, None, None), (102, "http://h.example/y", "", None)]
    got = {r["page_id"]: r for r in S.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i]["text"] == f"Story {i} tells {i * 7}." for i in range(30))
    assert got[100]["text"] == "Same line\nOnly page"
    assert got[101]["text"] == "" and got[101]["n_chars"] == 0 and got[102]["text"] == ""


def test_copies_count_once_in_a_tree(spark):
    rows = [(i, "http://c.example/", "<div class='a'>Copy</div><div class='b'>Again</div>", None) for i in range(40)]
    got = S.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 40 and {r["text"] for r in got} == {"Copy\nAgain"}


def test_importance_of_content_and_presentation(spark):
    rows = [(i, "http://h.example/", f"<div class='t'>Same</div><div class='v'>w{i} <b>x</b></div>" if i % 2 else
             f"<div class='t'>Same</div><div class='v'>w{i}</div>", None) for i in range(16)]
    parsed = S.page_blocks(spark.createDataFrame(rows, SCHEMA))
    got = {r["path"]: r for r in S.node_importance(parsed).collect()}
    assert abs(got["div.t"]["content"]) < 1e-9 and got["div.v"]["content"] == 1.0
    # two styles, eight pages each: ln 2 / ln 16
    assert abs(got["div.v"]["presentation"] - 0.25) < 1e-9
    assert abs(got["div.v"]["importance"] - (0.19 * 0.25 + 0.81)) < 1e-9


def test_empty_table(spark):
    assert S.extract(spark.createDataFrame([], SCHEMA)).count() == 0
    assert S.extract(spark.createDataFrame([], SCHEMA)).schema["n_chars"].dataType.simpleString() == "bigint"


def test_page_wide_marks_do_not_empty_the_page():
    body = "<nav>Menu</nav><article class='{}'><h1>T</h1><p>A</p><div class='share'>x</div></article><div class='sidebar'>S</div>"
    for around in ("<body class='page has-sidebar'>", "<body class='sidebar'>", "<body class='no-sidebar single-post'>",
                   "<div class='two-column with-sidebar'>", "<div class='widget'>", "<form id='aspnetForm'>", "<div class='content related'>"):
        for own in ("post comments-open", "comment", "content related"):
            assert text_of(around + body.format(own)) == "T\nA", (around, own)
    assert text_of("<div class='content related'><p>kept</p></div><div class='related'>no</div>") == "kept"
    long = " ".join(["word"] * 200)
    assert text_of(f"<a>Skip</a><form><div><p>{long}</p></div><nav>Menu</nav></form>") == f"Skip\n{long}"
    assert text_of("<div class='post'><p>The post is long enough</p></div><div class='comments'><article>First!</article></div>") == "The post is long enough"


def test_recurring_parts_stay_however_many_pages_a_host_has(spark):
    heads = ["Ingredients", "Method", "Summary", "Notes"]
    rows = [(i, "http://big.example/x", f"<article><h1>About</h1><h2>{heads[i % 4]}</h2><p>Text {i}</p></article>", None) for i in range(300)]
    rows += [(1000 + i, "http://plain.example/x", f"<div class='top'>Same</div><h2>{heads[i % 4]}</h2><p>Text {i}</p>", None) for i in range(300)]
    got = {r["page_id"]: r["text"] for r in S.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i] == f"About\n{heads[i % 4]}\nText {i}" for i in range(300))
    assert all(got[1000 + i] == f"{heads[i % 4]}\nText {i}" for i in range(300))


def test_self_closing_and_unclosed_icons_and_formulas():
    page = "<article><p>One <svg class='i'/> two.</p><p>Three.</p><p>Four.</p></article>"
    assert text_of(page) == "One two.\nThree.\nFour."
    assert text_of(page.replace("'/>", "'>")) == "One two.\nThree.\nFour."
    assert text_of("<p>a <svg><title>t</title><path d='x'/></svg>b <math><mi>x</mi><mo>=</mo><mn>1</mn></math> c") == "a b x=1 c"
    assert text_of("<p>a<select><option>x</select>b" + "<svg>" * 20000) == "ab"


def test_contents_that_marks_alone_would_lose():
    def text(page):
        return "\n".join(b[0] for b in S.usable(S.parse(page)))

    assert text("<article><div class='legal'><p>The law text is the topic.</p></div></article>") == "The law text is the topic."
    assert text("<body><nav><a>Home</a></nav><div class='legal'><p>Only this.</p></div></body>") == "Only this."
    assert text("<body><nav><a>Home</a></nav></body>") == ""
    body = "<p>" + "The main text goes on. " * 20 + "</p>"
    teasers = "<article><h3>Read on</h3></article><article><h3>And this</h3></article>"
    assert text(f"<body>{body}{teasers}</body>") == ("The main text goes on. " * 20).strip()
    assert text(f"<body><p>A short line above.</p><article>{body}</article></body>") == ("The main text goes on. " * 20).strip()
    for tag in ("style-x", "title-bar", "script-box"):
        assert text(f"<article><p>A</p><{tag}></{tag}><p>B</p><{tag}/><p>C</p></article>") == "A\nB\nC"
    assert text("<article><p>A</p><style>p {}</style><p>B</p><script>x</script-y></script><p>C</p></article>") == "A\nB\nC"
