import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import html as H
from millrace.llm import language as L
from millrace.llm import lines as R
from millrace.llm import mainbody as B
from millrace.llm import markup as M
from millrace.llm import mojibake as G
from millrace.llm import pages as P
from millrace.llm import residue as X

SCHEMA = "source string, id long, url string, html binary, line string, host string"


def frame(spark, rows):
    """Pages with extra columns whose names clash with the results'."""
    data = [(s, i, u, bytearray(h.encode("utf-8", "surrogatepass")) if h is not None else None, "x", "y") for s, i, u, h in rows]
    return spark.createDataFrame(data, SCHEMA)


def article(body, title="A long walk - Site", lang='lang="en"', tail=""):
    return f'<html {lang}><head><title>{title}</title></head><body><nav><a href="/">Home</a></nav><article><h1>A long walk</h1>{body}</article>{tail}</body></html>'


PROSE = "<p>After the rain stopped, they walked along the river for an hour.</p><p>Nobody said a word until the bridge came into sight.</p>"


def test_lines():
    p = H.render("<body>a<b>b</b>c<br>d&amp;amp;<p>e\n  f&nbsp;g<script>no</script><!-- no --><noscript>h</noscript><svg>no</svg> <i></i><td>z</body>x")
    assert p.lines == ["abc", "d&amp;", "e f g", "h", "z"]
    assert H.render(None).lines == [] and H.render("").lines == [] and H.render("just text").lines == ["just text"]
    assert H.render("<body><p>a<p>b<ul><li>c<li>d</ul><table><tr><td>e<td>f</table>").lines == list("abcdef")
    assert H.render("<!-- open " + "x" * 100).lines == []


def test_rendered_layout():
    p = H.render("<body><h1>T</h1><ul><li>a<li>b</ul><table><tr><td>one</td><td>1</td></tr><tr><td>x</td><td>22</td></tr></table><p hidden>no</p><p>z</p>")
    assert H.to_text(p) == "T\n\n- a\n- b\n\none  1\nx    22\n\nz"


def test_main_body():
    h = article(
        '<div class="box">By Ann Other</div>' + PROSE + '<div><a href="/x">Another story</a></div><p>Sponsored</p><p>See also: more</p><p>The end.</p>'
        "<div>Share this article with a friend</div><p>after the end</p>"
    )
    p = H.render(h)
    assert [p.lines[i] for i in B.main_blocks(p)] == ["A long walk", "After the rain stopped, they walked along the river for an hour.", "Nobody said a word until the bridge came into sight.", "The end."]
    assert B.main_blocks(H.render("<body></body>")) == []


WORDS = "Trước khi làm xét nghiệm máu, bệnh nhân cần nhịn ăn tám giờ và uống đủ nước theo hướng dẫn."
ZH = "连续服用三周后,多数患者的症状明显减轻,应尽快到医院复查。"


@pytest.mark.parametrize("text", [WORDS, ZH, "It’s “fine” – really, café naïve µg/dL ± 2."])
def test_restores_wrong_charsets(text):
    sloppy = lambda b: "".join(G._SHOWN[x] for x in b)
    once = sloppy(text.encode())
    twice = sloppy(once.encode())
    assert G.restore(once)[0] == text
    assert G.restore(twice)[0] == text
    assert G.garbled([once])[0] and G.garbled(["clean", twice])[0]
    if text == ZH:
        gbk = sloppy(text.encode("gb18030"))
        assert G.restore(gbk)[0] == text
    assert not G.garbled([text])[0]


def test_lost_characters():
    lost = "Tr??c khi l?m x?t nghi?m m?u, b?nh nh?n c?n nh?n ?n"
    assert G.garbled([lost])[0] and G.garbled(["a�b"])[0]
    for clean in ("Truoc khi lam xet nghiem mau", "Why? Because. Really?", "http://a.x/?a=1&b=2?c", "", WORDS.upper(), "Ménière’s disease: 5 µg ± 2 « x »", "维生素D和X光检查"):
        assert not G.garbled([clean])[0], clean
    import unicodedata

    assert not G.garbled([unicodedata.normalize("NFD", WORDS)])[0]


def judge(body_html, title="A long walk - Site"):
    p = H.render(article(body_html, title))
    head, body = B.with_headline(p)
    return X.judge(p, body, head)[0] in X.SURE


@pytest.mark.parametrize(
    "text",
    ["{{ name }}", "Dear ${user.name},", "<%= title %>".replace("<", "&lt;"), "#{city} is far", "@@x@@", "##price##", "__first_name__", "__name__", "%CITY%", "[Insert title here]", "[NAME]", "{0} items",
     "Call undefined now", "NaN", "[object Object]", "&lt;?php echo 1; ?&gt;", "Lorem ipsum dolor sit amet elit", "待补充", "Nhập nội dung tại đây"],
)
def test_residue(text):
    assert judge(PROSE + f"<p>{text}</p>")


@pytest.mark.parametrize(
    "text",
    ["Name: ________ Age: ____", "The value is undefined for zero.", "__very__ good", "See [12] and (*).", "{{note|text=a}}", "<pre>${x} {{y}}</pre>", "Error E-5 on the meter means the strip has expired.",
     "x^{2} + \\frac{1}{2}", "Medication errors: page 404 of the report found none.", "5 % of 10 %"],
)
def test_no_residue(text):
    assert not judge(PROSE + f"<p>{text}</p>" + PROSE)


@pytest.mark.parametrize("text", ["404 Not Found", "Your session has expired. Please sign in again.", "You need to enable JavaScript to run this app.", "页面不存在", "Hệ thống đang bảo trì"])
def test_message_bodies(text):
    p = H.render(f"<html><head><title>Site - Site</title></head><body><nav><a>Home</a></nav><div><h1>{text}</h1></div><footer>© 2020 Site</footer></body></html>")
    head, body = B.with_headline(p)
    assert X.judge(p, body, head)[0] == "message"
    q = H.render(f"<html><head><title>Site - Site</title></head><body><noscript>{text}</noscript></body></html>")
    if "JavaScript" in text:
        assert X.judge(q, *reversed(B.with_headline(q)))[0] == "message"


def test_recurring_messages(spark):
    """A short body worded like a message, in no phrase list, becomes a case where hosts share it."""
    def body(n):
        return f"<html><head><title>Loading - S</title></head><body><div><h1>Loading</h1><p>Please keep this browser tab open, step {n}</p></div></body></html>"

    shared = [("db", i, f"http://h{i}.x/", body(i)) for i in range(3)]
    alone = [("db", 9, "http://h.x/", body(1).replace("keep", "hold"))]
    facts = P.message_facts(frame(spark, shared + alone))
    assert {r["id"] for r in P.residue_pages(facts).collect()} == {0, 1, 2}


def test_page_operators(spark):
    garbled = "".join(G._SHOWN[x] for x in WORDS.encode())
    rows = [
        ("db", 1, "http://a.x/", article(PROSE)),
        ("db", 1, "http://a.x/", article(PROSE)),
        ("db_cc", 1, "http://a.x/", article(PROSE)),
        ("db", 2, "http://a.x/", article(f"<p>{garbled}</p>")),
        ("db", 3, "http://a.x/", article("<p>{{ name }}</p>")),
        ("db", 4, "http://a.x/", article(PROSE + "<p># **bold** and [[x|y]]</p>", lang="")),
        ("db", 5, "http://a.x/", None),
        ("db", 6, "http://a.x/", ""),
        ("db", 7, "http://a.x/", article(f"<p>{WORDS}</p><p>{WORDS}</p>" + PROSE)),
        ("db", 8, "http://a.x/", article(PROSE, lang='lang="vi-VN"') + "x" * 200_000),
    ]
    df = frame(spark, rows)
    assert {r["id"] for r in P.garbled_pages(df).collect()} == {2}
    fixed = P.restored_pages(df).first()
    assert WORDS in fixed["lines"] and fixed["restorable"]
    assert {r["id"] for r in P.residue_pages(P.message_facts(df)).collect()} == {3}
    lines = P.main_lines(df).collect()
    assert {r["id"] for r in lines} == {1, 4, 7, 8} and len(lines) == len(set(lines))
    langs = {(r["id"], r["lang"]) for r in P.page_languages(df).collect()}
    assert langs == {(4, "en"), (7, "en"), (7, "vi"), (8, "en")}
    assert {(r["id"], r["markup"]) for r in P.markup_pages(df).collect()} == {(4, "markdown"), (4, "wiki")}
    text = P.clean_markup(df).first()["text"]
    assert "bold" in text and "**" not in text and "[[" not in text
    seg = {(r["id"], r["segment"], r["lang"]) for r in P.language_segments(df).where("source = 'db'").collect()}
    assert (7, 0, "vi") in seg and (7, 1, "en") in seg and all(len(s) == 3 for s in seg)
    empty = df.limit(0)
    for f in (P.garbled_pages, P.main_lines, P.page_languages, P.markup_pages, lambda d: P.residue_pages(P.message_facts(d))):
        assert f(empty).count() == 0


def test_language_model():
    held_out = {
        "vi": ["Cháu bé bị sốt cao nên gia đình đưa vào bệnh viện ngay trong đêm.", "Chau be bi sot cao nen gia dinh dua vao benh vien ngay trong dem.", "Mua he nam nay nong hon moi nam rat nhieu."],
        "en": ["The child had a high fever, so the family drove to the hospital that night.", "This summer is much hotter than the ones before it.", "Guillain–Barré syndrome is rare."],
        "zh": ["孩子发高烧,家人当晚就把他送到了医院。", "今年夏天比往年热得多。", "注意休息,多喝水。"],
    }
    for lang, lines in held_out.items():
        kinds, sure = L.classify(lines)
        assert [L.LANGUAGES[k] for k in kinds] == [lang] * len(lines)
        assert (sure > 0.5).all()
    assert len(L.classify([])[0]) == 0 and len(L.classify([""])[0]) == 1
    assert L.declared("<html>") == "" and L.declared("<html lang=''>") == "" and L.declared('<html lang="und">') == "" and L.declared("<HTML LANG=zh-CN>") == "zh"
    assert L.declared('<html><meta http-equiv="Content-Language" content="EN-gb">') == "en" and L.declared('<html lang=""><meta http-equiv=content-language content=vi>') == ""
    assert L.page_languages([0, 0, 1], [True] * 3) == ["vi"] and L.page_languages([1], [False]) == ["en"] and L.page_languages([], []) == []


def test_precomposed_kernel_equals_the_kernel():
    """Scores by the multiplied-out matrix are those of kernel values to landmarks."""
    lines = ["They walked along the river.", WORDS, ZH, "", "1"]
    weights, bias = L.model()
    direct = L._cosines(L.presence(lines)) @ weights + bias
    assert abs(direct - L.scores(lines)).max() < 1e-4


def test_markup_kinds():
    hit = {
        "html": ["a <b>c</b>", "x &nbsp; y", "<p class='m'>z", "</td>"],
        "markdown": ["## T", "a **b** c", "`x`", "```", "![a](/b.png)", "[a](/b)", "|---|---|", "| a | b |", "a __b__ c"],
        "wiki": ["[[a|b]]", "== T ==", "'''b'''", "{{note|text=a}}", "{| class=x", "|-", "| a || b", "x<ref>1</ref>"],
        "latex": [r"\section{T}", r"\begin{x}", r"a\textbf{b}", r"$$ x^{2} $$", r"a & b \\", r"\item x", r"$\frac{1}{2}$"],
    }
    for kind, lines in hit.items():
        for s in lines:
            assert kind in M.kinds_in([s]), (kind, s)
    for s in ["Name: ____", "p < 0.05 & SpO2 > 90%", "see [3]", "$10 - $20*, (*) net", "——— x", "a * b = c", "C:\\temp", "1. one", "AT&T", "x_1 = 2", "rock 'n' roll"]:
        assert M.kinds_in([s]) == [], s
    assert M.clean_line("<tr><td>a</td><td>b</td></tr>", {"html"}) == "a | b"
    assert M.clean_line(r"\subsection{T}", {"latex"}).endswith("# T") and M.clean_line("|-", {"wiki"}) is None
    assert M.clean_text(["```", "a **b**", "```", "**c**"], ["markdown"]) == "```\na **b**\n```\nc"


def test_trees_and_decoding():
    r = random.Random(5)
    pages = [H.render(article(PROSE * r.randint(1, 4), tail="<footer>" + "".join(f"<p>Terms of use {i}</p>" for i in range(r.randint(1, 5))) + "</footer>")) for _ in range(40)]
    model = M.fit(pages)
    p = pages[0]
    assert M.content_blocks(p, model) == B.main_blocks(p)
    # no descendant contradicts its ancestor, whatever the probabilities
    rng = np.random.default_rng(1)
    for p in pages[:10]:
        blocks = set(M.decode(p, rng.normal(size=(len(p.tag) + len(p.lines), 3))))
        assert blocks <= set(range(len(p.lines)))
    assert M.fit([]) and M.content_blocks(H.render(""), model) == []


def brute_repeated(rows):
    docs = {}
    for _, i, u, h in rows:
        if h is not None:
            docs.setdefault((P.host_of(u), i), set(R.page_lines(h)))
    out = set()
    for host in {k[0] for k in docs}:
        own = [v for k, v in docs.items() if k[0] == host]
        for line in set().union(*own):
            n = sum(line in d for d in own)
            if n >= 5 and n * 4 >= len(own):
                out.add((host, line))
    return out


def test_repeated_lines(spark):
    r = random.Random(2)
    rows = []
    for i in range(120):
        host = "hot.x" if i % 3 else r.choice(["a.x", "www.b.x:80", "c.x"])
        lines = [f"Line {r.randint(0, 9)} of 9"] + [w for w in ("share", "Imprint 2020", "rare") if r.random() < {"share": 0.9, "Imprint 2020": 0.3, "rare": 0.1}[w]] + [f"own {chr(97 + i % 26)}{'x' * i}"]
        rows.append(("db", i, f"http://{host}/{i}", "<body>" + "<p>".join(lines)))
    rows += [("db_cc", *x[1:]) for x in rows[:30]] + [("db", 500, "http://hot.x/", None), ("db", 501, "http://hot.x/", ""), ("db", 502, "http://e.x/", "<body>only")]
    df = frame(spark, rows).repartition(5)
    want = brute_repeated(rows)
    assert {(x["host"], x["line"]) for x in R.repeated_lines(df).collect()} == want and want
    seqs = R.frequent_sequences(df).collect()
    assert {x["host"] for x in seqs if x["length"] == 1} == {h for h, _ in want}
    for x in R.without_repeated(df).collect():
        assert not {(x["host"], R.normal(s)) for s in x["lines"] or []} & want
    assert R.repeated_lines(df.limit(0)).count() == 0


def test_repeated_lines_common_in_no_split(spark, monkeypatch):
    """The exact way for frequent lines whose text no split told."""
    monkeypatch.setattr(R, "HINT_SHARE", 2.0)
    rows = [("db", i, "http://h.x/", f"<body><p>same {i}<p>own {'x' * i}") for i in range(8)]
    assert {tuple(x) for x in R.repeated_lines(frame(spark, rows)).collect()} == {("h.x", "same 0")}


def test_nulls_in_any_column(spark):
    rows = [(None, None, None, article(PROSE + "<p>**b**</p>")), ("db", None, None, article("<p>{{ name }}</p>")), (None, 3, "", "<body>�"), ("db", 4, None, None)]
    df = frame(spark, rows)
    bad = spark.createDataFrame([("db", 9, "http://a.x/", bytearray(b"<body>\xff\xfe text"), "x", "y")], SCHEMA)
    df = df.unionByName(bad)
    assert {(r["source"], r["id"]) for r in P.garbled_pages(df).collect()} == {(None, 3), ("db", 9)}
    assert {(r["source"], r["id"]) for r in P.residue_pages(P.message_facts(df)).collect()} == {("db", None)}
    assert {(r["source"], r["id"]) for r in P.main_lines(df).collect()} == {(None, None)}
    assert {r["markup"] for r in P.markup_pages(df).collect()} == {"markdown"}
    assert P.page_languages(df).count() == 0
    assert R.repeated_lines(df).count() == 0 and R.without_repeated(df).count() == 3  # rows of a host without an id are one document


def main_of(body):
    p = H.render(article(body))
    return [p.lines[i] for i in B.main_blocks(p)][1:]


@pytest.mark.parametrize("prompt", ["<div>Share this article with a friend</div>", "<div>Most read</div><ul><li><a href=/x>Another story</a></li><li>A third story</li></ul>", "<p>Chia sẻ bài viết này với người thân của bạn</p>", "<p>By using this site you agree to our cookie policy</p>", "<p>© 2020 Site</p>"])
def test_article_goes_on_after_furniture(prompt):
    more = "<p>The bridge was closed, so they turned back at dusk.</p><p>Home at last</p>"
    assert main_of(PROSE + prompt + more)[2:] == ["The bridge was closed, so they turned back at dusk.", "Home at last"]
    assert main_of(PROSE + prompt + "<h2>Back home</h2><p>Tea</p>")[2:] == ["Back home", "Tea"]
    assert len(main_of(PROSE + prompt + "<p>Comments (2)</p><div>Thank you, this was a good walk.</div>")) == 2


@pytest.mark.parametrize(
    "line",
    ["Follow your doctor's advice for at least six weeks.", "Like other pain killers, it acts on the nerves.", "Share this information with your nurse.", "Sign up for a first-aid class before the birth.", "Many children prefer cookies to fruit.",
     "Reproduction of the virus requires a host cell.", "Do not delay seeking care because you fear the cost.", "The information on the leaflet is short.", "Theo dõi trang thiết bị y tế mỗi ngày."],
)
def test_sentences_that_are_no_furniture(line):
    assert main_of(PROSE + f"<p>{line}</p><p>Rest well.</p>")[2:] == [line, "Rest well."]


@pytest.mark.parametrize("line", ["Follow Vahube for daily health tips", "Follow us on Facebook", "Sign up for the weekly Vahube newsletter", "Email this page to a friend", "Vahube stores cookies to remember your preferences.", "Vahube is a service of the Luruda Institute for patient information", "Print this"])
def test_furniture_prompts(line):
    assert B.furniture(line) in B.CLOSING


LONG_VI = WORDS + " Sau đó, người bệnh nên nghỉ ngơi, ăn nhẹ và trao đổi với bác sĩ về các thuốc đang dùng; kết quả thường có sau hai ngày làm việc."


@pytest.mark.parametrize("text", [ZH + "医生说这是‘’正常的现象,不必担心,继续按时服药即可,两周后再来复查一次血常规。", LONG_VI, "The dose of this drug was halved in the second week " * 4 + "and then stopped."])
@pytest.mark.parametrize("mark", ["’", "–", "—"])
def test_damage_at_one_place_of_a_long_line(text, mark):
    sloppy = "".join(G._SHOWN[x] for x in mark.encode())
    half = len(text) // 2
    good, bad = text[:half] + f" {mark} " + text[half:], text[:half] + f" {sloppy} " + text[half:]
    assert G.garbled(["clean", bad])[0] and G.garbled(["clean", bad], all_lines=True)[1] == [(1, good)]
    assert not G.garbled([good])[0]


MESSAGES = ["Please enable JavaScript to view this content.", "502 Bad Gateway", "HTTP 500", "Error 404: page not found", "Sorry, the page you requested could not be found.", "Your session has expired.", "An unexpected error occurred.", "Hệ thống đang bảo trì",
    "Lỗi 503", "Xin lỗi, bài viết này đã bị xóa.", "您访问的页面不存在", "请启用JavaScript后继续浏览", "TypeError: x is not a function", "This site requires JavaScript to show the article. " + "Open the settings of the browser and look for the entry that deals with scripts. " * 4]


@pytest.mark.parametrize("text", MESSAGES)
@pytest.mark.parametrize("times", [1, 6])
def test_message_in_an_article(text, times):
    assert judge(PROSE + f"<p>{text}</p>" + PROSE * times)
    assert not judge(PROSE + f"<pre>{text}</pre>" + PROSE * times)


@pytest.mark.parametrize(
    "text",
    ["Wait 15 minutes before the second dose.", "This link between smoking and the illness is no longer in doubt.", "The content of iron was found to be low.", "Upstream causes are not known.", "Hãy quay lại tái khám sau hai tuần.", "Hệ thống miễn dịch bị quá tải.",
     "没有找到病因的患者应复查。", "404", "The page 404 of the report is missing.", "Sorry is a hard word to say.", "Access to care is denied to many.", "Nội dung của bài viết dựa trên 500 ca."],
)
def test_no_message_in_an_article(text):
    assert not judge(PROSE + f"<p>{text}</p>" + PROSE * 6) and not judge(PROSE + f"<p>{text}</p>" + PROSE)


@pytest.mark.parametrize("line", ["Trước khi l?m xét nghiệm", "bệnh nh?n cần nhịn ăn", "The caf? is closed, the caf?s too", "bệnh nhân hiểu; người nhà cũng hi?u", "Người bệnh nh? nhà thăm"])
def test_a_single_lost_letter(line):
    assert G.garbled(["clean", line])[0] and G.garbled(["clean", line], all_lines=True)[0]


@pytest.mark.parametrize("line", ["Why?because it rains", "có sao không?em lo lắm", "是不是痛风?医生您好", "uống mấy mg? em quên", "see http://a.x/p?q and b?c=1", "Is it bad?No", "ok?thx"])
def test_real_questions(line):
    assert not G.garbled(["clean", line])[0]


def test_sequences_grow_to_their_full_length(spark):
    """A footer of seven lines comes out whole; its tails have the same support and are not listed."""
    foot = [f"foot {c}" for c in "abcdefg"]
    rows = [("db", i, "http://h.x/", "<body><p>" + "<p>".join([f"own {'x' * i}", *foot, "mid", f"z{'y' * i}"][: 9 if i < 6 else 4])) for i in range(8)]
    got = {(x["length"], x["n_docs"]) for x in R.frequent_sequences(frame(spark, rows)).collect()}
    assert got == {(n, 8) for n in (1, 2, 3)} | {(1, 6)} | {(n, 6) for n in range(4, 9)}
    assert R.frequent_sequences(frame(spark, rows).limit(0)).count() == 0


def brute_sequences(docs, least):
    """Support of every run of lines in at least ``least`` documents."""
    support = {}
    for d in docs:
        for run in {tuple(d[i:j]) for i in range(len(d)) for j in range(i + 1, len(d) + 1)}:
            support[run] = support.get(run, 0) + 1
    return {s: n for s, n in support.items() if n >= least}


def listed(docs, frequent):
    """Without the sequences whose first line always follows one frequent line."""
    left = {}
    for d in docs:
        for a, b in zip([None, *d], d):
            left.setdefault(b, set()).add(a)
    tied = {b for b, a in left.items() if len(a) == 1 and (next(iter(a)),) in frequent}
    for s, n in frequent.items():
        if len(s) > 1 and s[0] in tied:
            assert frequent[(next(iter(left[s[0]])), *s)] == n  # the tail of a longer one with the same support
    return {s: n for s, n in frequent.items() if len(s) == 1 or s[0] not in tied}


def test_mined_as_by_brute_force():
    r = random.Random(5)
    for _ in range(40):
        blocks = [[1, 2, 3, 4], [5, 6], [7, 8, 9], [2, 3], [10], [11], [12]]
        docs = [[x for b in r.choices(blocks, k=r.randint(0, 6)) for x in b if r.random() < 0.95] for _ in range(30)]
        docs = [[x for i, x in enumerate(d) if not i or d[i - 1] != x] for d in docs]
        least = r.randint(2, 12)
        want = brute_sequences(docs, least)
        arrays = [np.array(d, np.int64) for d in docs]
        found = R.mine(arrays, least)
        assert len(found) == len({tuple(s) for s, _, _ in found}) and {tuple(s): n for s, n, _ in found} == listed(docs, want)
        assert {tuple(s): n for s, n, _ in R.mine(arrays, least, frozenset(range(20)))} == want
        some = [*want][:50]
        assert R.holding(arrays, [list(s) for s in some]) == [want[s] for s in some]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sequences_over_chunks(spark, monkeypatch, seed):
    """A source in many chunks, some of which miss what is frequent as a whole or see a line always after another."""
    monkeypatch.setattr(R, "CHUNK_DOCS", 12)
    r = random.Random(seed)
    docs = []
    for i in range(150):
        d = [1, 2, 3] if r.random() < 0.34 else [9, 2, 3] if r.random() < 0.4 else [2]
        docs.append([100 + i, *d, 200 + i, *([4, 5, 6, 7, 8, 10, 11, 12, 13] if r.random() < 0.36 else [5, 6]), 300 + i])
    rows = [("db", i, "http://h.x/", "<body><p>" + "<p>".join(f"t {chr(96 + x) if x < 99 else 'y' * x}" for x in d)) for i, d in enumerate(docs)]
    rows += [("db", 500 + i, "http://small.x/", "<body><p>one<p>two") for i in range(6)] + rows[:40] + [rows[0]] * 60
    df = frame(spark, rows).repartition(6)
    got = {tuple(x["seq"]): x["n_docs"] for x in R.frequent_sequences(df).where("host = 'h.x'").collect()}
    name = lambda x: R.line_id(f"t {chr(96 + x) if x < 99 else 'y' * x}")
    hashed = [[name(x) for x in d] for d in docs]
    want = listed(hashed, brute_sequences(hashed, 38))
    assert {s for s in want if len(s) == 9} and want.items() <= got.items()
    # sources in several chunks may list some tails more
    assert got.items() <= brute_sequences(hashed, 38).items()
    assert {tuple(x) for x in R.repeated_lines(df).where("host = 'small.x'").collect()} == {("small.x", "one"), ("small.x", "two")}


def test_cleaned_by_either_way(spark, monkeypatch):
    rows = [("db", i, f"http://h{i % 2}.x/", f"<body><p>Menu {i}<p>own {'x' * i}<p>end") for i in range(14)] + [("db_cc", 1, "http://h1.x/", "<body><p>Menu 1<p>own x<p>end"), ("db", 99, None, "<body>")]
    want = {(f"h{i % 2}.x", i, (f"own {'x' * i}".strip(),), 2) for i in range(14)} | {("", 99, (), 0)}
    for most in (R.SENT_LINES, 0):
        monkeypatch.setattr(R, "SENT_LINES", most)
        got = [(x["host"], x["id"], tuple(x["lines"]), x["n_removed"]) for x in R.without_repeated(frame(spark, rows)).collect()]
        assert set(got) == want and len(got) == len(want)


SEVEN = "".join(f"<p>{w} walked along the river for an hour and said nothing.</p>" for w in "They We You He She Nobody Everybody".split())


def verdict(html):
    p = H.render(html)
    head, body = B.with_headline(p)
    return X.judge(p, body, head)[0]


@pytest.mark.parametrize(
    "line",
    ["Sorry, the page you requested does not exist.", "Enable JavaScript to view this page.", "Dear *|FNAME|*, welcome", "502 Bad Gateway", "Trang này không tồn tại.", "该页面不存在", "Internal Server Error", "Please enable scripts to read on",
     "Hello {{ user.name }}", "Lorem ipsum dolor sit amet, consectetur adipiscing elit"],
)
def test_residue_in_a_long_body(line):
    assert verdict(article(SEVEN + f"<p>{line}</p>")) in X.SURE
    assert verdict(article(SEVEN)) == "" and verdict(article(f"<p>{line}</p>")) in X.SURE


def test_many_error_lines_are_a_message():
    lines = ["Oops, no luck.", "Try again later.", "Error code 77", "Come back soon.", "Not found", "Reference #12", "Unauthorized", "nginx/1.2"]
    assert verdict(article("".join(f"<p>{x}</p>" for x in lines))) == "message"


@pytest.mark.parametrize("line", ["An error in the dose can be dangerous.", "Many patients were not found in the register.", "The clinic closed for maintenance in May.", "He was denied access to care for years.", "Doctors say javascript games calm children."])
def test_articles_about_errors_are_no_residue(line):
    assert verdict(article(SEVEN + f"<p>{line}</p>")) == ""


def test_message_in_an_unknown_language(spark):
    """A short text that is all there is on several hosts, and copies of an article that are not."""
    page = lambda title, body: f"<html><head><title>{title}</title></head><body><h1>{title}</h1>{body}</body></html>"
    error = page("Fehler 17", "<p>Die Seite gibt es leider nicht mehr.</p>")
    rows = [("db", i, f"http://h{i}.x/", error.replace("17", str(i))) for i in range(4)] + [("db", 10 + i, f"http://h{i}.x/", article(SEVEN)) for i in range(5)]
    rows += [("db", 20 + i, f"http://one.x/{i}", page("Hinweis", "<p>Bitte warten.</p>")) for i in range(9)] + [("db", 30, "http://a.x", page("title", "")), ("db", 31, "http://b.x", page("Sale", "<p>[TITLE]</p>"))]
    df = frame(spark, rows)
    assert {r["id"] for r in P.residue_pages(P.message_facts(df)).collect()} == {0, 1, 2, 3, 31}
    assert {r["id"] for r in P.main_lines(df).collect()} == {*range(10, 15), *range(20, 29), 30}
    groups = P.messages(P.message_facts(df)).where("kind = 'body'").collect()
    assert sorted((g["n_hosts"], g["n_pages"], g["is_residue"]) for g in groups) == [(1, 1, False), (1, 9, False), (4, 4, True)]


def test_lines_of_other_languages(spark):
    foreign = ["El paciente debe beber agua con las comidas.", "Пациент должен пить воду после еды каждый день.", "食後に水をたくさん飲んでください。", "Le médecin conseille de boire de l'eau.", "Der Arzt rät, viel Wasser zu trinken."]
    assert [int(k) for k in L.classify(foreign)[0]] == [L.REST] * len(foreign)
    assert [int(k) for k in L.classify(["Why does chronic sinusitis cause pale skin?", "Uong thuoc sau khi an com.", "BMI 22,正常。"])[0]] == [1, 0, 2]
    body = "".join(f"<p>{s}</p>" for s in foreign[:1] * 3)
    rows = [("db", 1, "http://a.x", article(body, lang="")), ("db", 2, "http://a.x", article(body + PROSE, lang=""))]
    assert {(r["id"], r["lang"]) for r in P.page_languages(frame(spark, rows)).collect()} == {(2, "en")}


@pytest.mark.parametrize("times", [1, 2, 3, 5, 6])
def test_text_encoded_many_times(times):
    bad = WORDS
    for _ in range(times):
        bad = "".join(G._SHOWN[x] for x in bad.encode())
    assert G.garbled(["clean", bad])[0] and G.garbled(["clean", bad], all_lines=True)[1] == [(1, WORDS)]


def test_title_is_restored(spark):
    bad = "".join(G._SHOWN[x] for x in WORDS.encode())
    rows = [("db", 1, "http://a.x", f"<title>{bad}</title><body><p>calm words here"), ("db", 1, "http://a.x", f"<title>{bad}</title><body><p>calm words here")]
    got = P.restored_pages(frame(spark, rows)).collect()
    assert [(r["title"], r["lines"], r["n_restored"], r["restorable"]) for r in got] == [(WORDS, ["calm words here"], 1, True)]


def test_fit_sample_is_the_same_in_any_order(spark):
    rows = [("db", i % 40, "http://a.x", f"<body><p>{i % 40}" + "x" * (300 if i % 7 == 0 else 0)) for i in range(120)] + [("db", 7, "http://a.x", None)]
    df = frame(spark, rows)
    one = P.fit_sample(df, 10, 200)
    assert one == P.fit_sample(df.repartition(7), 10, 200) == P.fit_sample(df.orderBy(F.desc("id")), 10, 200)
    assert len(one) == len(set(one)) == 10 and max(map(len, one)) < 200
    assert P.fit_sample(df.limit(0)) == []


def test_trees_on_pages_not_fitted(spark, small):
    """Held-out accuracy of the blocks' labels."""
    bodies = P.fit_sample(spark.read.parquet(f"{small}/pages.parquet"))
    pages = [p for p in map(H.render, bodies) if p.lines]
    half = len(pages) // 2
    model = M.fit(pages[:half])
    right = total = 0
    for p in pages[half:]:
        got, want = set(M.content_blocks(p, model)), set(B.main_blocks(p))
        right += len(p.lines) - len(got ^ want)
        total += len(p.lines)
    print("held-out block accuracy", right / total, "of", total)
    assert right >= 0.9 * total


def test_repeated_lines_same_as_sql(spark, small):
    from millrace.llm import queries

    from ..oracle import assert_same, views

    con = views(small)
    for name, sql in queries.SQL.items():
        assert_same(queries.QUERIES[name](spark, small), con, sql)


def test_main_text_as_laid_out(spark):
    body = PROSE + "<h2>Doses</h2><ul><li>one<li>two</ul><table><tr><td>drug</td><td>5 mg</td></tr><tr><td>a</td><td>10 mg</td></tr></table><div class=share>Share this page</div><p>The end.</p>"
    rows = [("db", 1, "http://a.x", article(body)), ("db", 1, "http://a.x", article(body)), ("db", 2, "http://a.x", None), ("db", 3, "http://a.x", article("<p>{{ x }}</p>"))]
    got = P.main_texts(frame(spark, rows)).collect()
    assert [(r["source"], r["id"]) for r in got] == [("db", 1)]
    assert got[0]["text"].endswith("Doses\n\n- one\n- two\n\ndrug  5 mg\na     10 mg\n\nThe end.") and "Share" not in got[0]["text"] and "Home" not in got[0]["text"]
