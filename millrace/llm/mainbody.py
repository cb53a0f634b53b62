"""Main body of a page from its rendered blocks.

The renderer (:mod:`.html`) emits all visible text in layout order; this module
keeps the blocks of the page's own article. It anchors on the headline (the
block that repeats the document title, else the first heading), takes the
smallest layout box around it that holds more than the headline, and walks its
blocks in layout order, leaving out side boxes, blocks that are nothing but a
link, and blocks worded like site furniture. Share prompts, related lists,
cookie notes and imprints are passed over: the article goes on where a
sub-heading or running text of its box follows, and ends with the last such
block. What stands below the heading of reader comments is theirs.
"""

from __future__ import annotations

import re

from .html import Page

# Fixed phrases: wording of furniture in the three languages of the corpus.
# Each alternative must match from the start of a line.
AUTHOR = re.compile(
    r"(?:tác giả|người viết|biên tập(?: viên)?|tham vấn y khoa|thực hiện|theo nguồn|nguồn)\s*:"
    r"|(?:bs|ths|ts|pgs|gs)\.(?:\s*(?:bs|ths|ts|ckii?)\.)*\s.{2,60}tham vấn chuyên môn$"
    r"|(?:(?:medically |clinically |fact )?(?:reviewed|checked|edited)|written|posted|published) by\s[^.:!?]{2,80}$"
    r"|by (?!the )[^\d.,;:!?]{3,60}(?:\s[|·•-]\s.*\d{4})?$"
    r"|(?:author|editor|source|reviewer)\s?:\s"
    r"|(?:作者|编辑|责任编辑|责编|审核医生|审稿|撰文|来源|文)\s?[::]\s?\S{1,40}"
    r"|(?:published|updated|last updated|posted|cập nhật|ngày đăng|đăng ngày|发布时间|更新时间|发布日期)(?: on| ngày| lúc|\s?[::])?\s*\d",
    re.I,
)
AD = re.compile(
    r"(?:quảng cáo|nội dung tài trợ|được tài trợ|tài trợ|advertisement|advertising|sponsored(?: content)?|promoted(?: content)?|ad|ads"
    r"|推广|广告|赞助内容|赞助|商业推广)\W*$",
    re.I,
)
EDITORIAL = re.compile(
    r"(?:đính chính|cải chính|lưu ý của (?:ban )?biên tập|correction|editor[’']s note|clarification)\s?:"
    r"|bài viết (?:này )?thuộc (?:chuyên đề|loạt bài)|this (?:piece|article|story) (?:belongs to|is part of) "
    r"|(?:更正|勘误|编者按|编者注)\s?[::]|本文(?:属于|选自|系).{0,40}(?:专题|系列|栏目)",
    re.I,
)
READ_MORE = re.compile(
    r"(?:>>|»|▶|→)\s*\S|(?:xem thêm|đọc tiếp|đọc thêm|bài liên quan|tham khảo thêm|see also|read more|related|more on this|read next)\s?(?:[::]|$|(?=[A-Z]))"
    r"|see also |read more |(?:点击查看|相关阅读|延伸阅读|推荐阅读|更多阅读|查看更多|参见)\s?[::]",
    re.I,
)
_NETWORK = r"(?:facebook|twitter|x|youtube|instagram|tiktok|zalo|telegram|whatsapp|linkedin|pinterest|social media)\b"
#: These are passed over, with what follows until the article goes on, when they stand alone on a line.
SHARE = re.compile(
    r"(?:hãy )?(?:chia sẻ|gửi) (?:bài|trang)(?: viết)?(?: này)?(?: với| cho| lên| đến| qua|$)|thích trang .{1,60} để |bấm (?:theo dõi|thích|like) "
    r"|theo dõi (?:kênh|trang(?! thiết)|fanpage) |đăng ký (?:nhận (?:bản )?(?:tin|thông báo|email|thư)|kênh |theo dõi (?:kênh|trang|fanpage|bản tin))|tải (?:ứng dụng|app) |bài viết (?:này )?(?:có )?hữu ích"
    r"|(?:share|e-?mail|print) this(?: (?:article|page|story|post|link|video)\b|\W*$)|tell us what you think|tell (?:us|a friend)(?: about (?:this|us)\b.{0,40})?\W*$|was this (?:page|article) "
    rf"|like .{{1,60}} on {_NETWORK}.{{0,20}}$|like (?:us|our page|this page)\W*$|follow .{{1,60}} channel\b.{{0,30}}$|follow .{{1,60}} on {_NETWORK}.{{0,20}}$|follow us\b.{{0,40}}$"
    r"|follow (?!(?:your|the|these|this|a|an|all|any)\b).{1,60} for (?:\w+ ){0,2}(?:tips|news|updates|stories|posts)\W*$"
    r"|get the .{1,60} app\b|download .{1,60} app\b|subscribe to |sign up (?:for|to) .{0,60}(?:newsletter|mailing list|e-?mails?|updates|alerts|digest|bulletin)\b|join .{1,60} newsletter"
    r"|分享(?:到|给|本)|觉得有用请|点赞|收藏本页|转发给|关注.{1,40}(?:公众号|微信|微博)|下载.{1,40}客户端|订阅.{1,40}(?:简报|周刊|邮件)|扫码(?:关注|下载|加|添加|订阅|分享)|扫码\W*$",
    re.I,
)
RELATED_HEAD = re.compile(
    r"(?:tin mới(?: nhất)?|có thể bạn quan tâm|bài cùng chuyên mục|đọc nhiều(?: nhất)?|bài viết liên quan|tin liên quan|cùng chủ đề|xem nhiều"
    r"|latest(?: news)?|in this section|further reading|editor[’']?s picks|you may also like|most read|most popular|more in this section|related (?:articles|stories|posts)|recommended(?: for you)?|trending"
    r"|最新资讯|猜你喜欢|同类推荐|热门文章|热门推荐|相关文章|相关推荐|推荐阅读|大家都在看|最新文章|阅读排行|本栏推荐|栏目推荐|精彩推荐)\W*$",
    re.I,
)
COMMENTS = re.compile(
    r"(?:bình luận|ý kiến bạn đọc|comments?|reader comments|网友评论|读者评论|评论|留言)\s*(?:[(\[(]\s*[\d.,]*\s*[)\])]|[::]?\s*\d*)$", re.I
)
COOKIE = re.compile(r"(?=.{0,160}$)(?=.*(?:\bcookies?\b|浏览信息|隐私偏好))(?=.*(?:polic(?:y|ies)|privacy|settings|preferences|\b(?:this|our) (?:web)?site\b|brows|partners|(?:we|accept|use of)(?: use| all)? cookies|trang|truy cập|trải nghiệm|chính sách|riêng tư|website|[一-鿿]))(?=.*(?:đồng ý|chấp nhận|sử dụng|dùng|accept|agree|prefer|by using|manage|partners|同意|保存|体验|记录|使用|store))", re.I)
FOOTER = re.compile(
    r"(?:©|\(c\) )\s*\d{4}|copyright\b|bản quyền|版权所有|.{1,40}版权所有|all rights reserved|.{1,60}giữ toàn quyền"
    r"|lượt (?:truy cập|xem)\s?:|page views\s?:|浏览量\s?[::]|访问量\s?[::]|giấy phép (?:số|mxh)|备案号|.{0,4}icp备|cơ quan chủ quản\s?:|tòa soạn\s?:|chịu trách nhiệm(?:\s?:| (?:nội dung|chính|xuất bản|quản lý|biên tập))"
    r"|registered office|.{1,60} is a service of [^.]{1,80}$|客服热线|主办单位|联系电话|điều khoản (?:sử dụng|dịch vụ)|chính sách bảo mật|terms of (?:use|service)|privacy (?:notice|policy)"
    r"|关于我们|隐私声明|网站地图|last site update|reproduction of .{1,60} requires .{0,30}(?:permission|consent)|content on .{1,60} (?:is|does) (?:for |not |no |provided |intended )|cập nhật (?:trang|website) lần cuối|ghi rõ nguồn |thông tin trên trang |nội dung trên .{1,60} chỉ mang tính"
    r"|do not delay seeking care because of (?:something|anything|what)\b|the (?:content|information) on (?:this (?:web)?site\b|.{1,40} (?:is (?:for |no |not (?:a |an |intended|meant)|provided|intended)|does not (?:replace|substitute|constitute)))|(?:nothing|content) on this (?:site|page)"
    r"|本站内容仅供参考|本站.{0,20}不能(?:作为|代替)|如有不适请及时就医,切勿|hotline\s?:|đường dây nóng\s?:",
    re.I,
)
NOTICE = re.compile(r"(?=.{0,160}$)(?=.*(?:script|脚本)).*(?:một số tính năng|some (?:features|functions|parts)|部分功能|certain features)", re.I)
SCRIPT_NOTE = re.compile(r"(?=.{0,120}$).*(?:javascript|\bscripts?\b|脚本)", re.I)
CRUMB = re.compile(r"(?:trang chủ|home|首页)\s*(?:[>»›/|·]|\S{0,12}\s*[>»›/]).{0,200}$", re.I)
BAR = re.compile(r"[^|]{1,30}(?:\s?[||]\s?[^|]{1,30}){2,}$")

FURNITURE_CLASS = re.compile(
    r"(?:^|[\s\"'=_-])(?:share|social|related|recommend|comment|comments|author|byline|meta|breadcrumb|crumb|path|cookie|gdpr|consent|newsletter"
    r"|subscribe|sidebar|aside|widget|menu|nav|navbar|footer|copyright|colophon|advert|ads?|sponsor|promo|banner|tags|toolbar|entry-more|read-more|popup|modal)"
    r"(?=$|[\s\"'_-])",
    re.I,
)
_CLASS_ATTR = re.compile(r"(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_SIDE_TAGS = frozenset("nav aside footer form button select textarea noscript iframe dialog menu".split())
_TITLE_TAIL = re.compile(r"^(.*\S)\s+[-–—|_]\s+[^-–—|_]*$")

LEXICON = (
    ("author", AUTHOR), ("ad", AD), ("editorial", EDITORIAL), ("more", READ_MORE), ("share", SHARE), ("related", RELATED_HEAD),
    ("comments", COMMENTS), ("cookie", COOKIE), ("footer", FOOTER), ("notice", NOTICE),
)
CLOSING = frozenset(["share", "related", "comments", "cookie", "footer"])
_ANY = re.compile("|".join(f"(?P<{name}>{rx.pattern})" for name, rx in LEXICON), re.I)
_cache: dict[str, str] = {}


def furniture(line: str) -> str:
    """Name of the furniture class a line is worded like, or ``""``."""
    kind = _cache.get(line)
    if kind is None:
        m = _ANY.match(line)
        kind = (m.lastgroup or "") if m else ""
        if len(_cache) > 200_000:
            _cache.clear()
        _cache[line] = kind
    return kind


def title_core(title: str) -> str:
    """The title without the site's name after the last separator."""
    m = _TITLE_TAIL.match(title)
    return m.group(1) if m else title


def _side(page: Page, node: int) -> bool:
    """Whether an element below the article's box is a side box by tag or class."""
    if page.hidden[node] or page.tag[node] in _SIDE_TAGS:
        return True
    a = page.attrs[node]
    if a:
        for v in _CLASS_ATTR.findall(a):
            if FURNITURE_CLASS.search(v):
                return True
    return False


def _inside(page: Page, node: int, tags: frozenset[str]) -> bool:
    while node > 0:
        if page.tag[node] in tags:
            return True
        node = page.parent[node]
    return False


_NOT_HEADLINE = frozenset("nav aside footer li button noscript".split())
_HEADINGS = frozenset(["h1", "h2", "h3"])
_SUBHEADINGS = frozenset(["h2", "h3", "h4", "h5", "h6"])
_SENTENCE_END = re.compile(r"[.!?。!?…][\"'”’»)\])」]*$")
#: A line of so many characters is running text even without a full stop.
RUNNING = 80


def _goes_on(line: str, tag: str) -> bool:
    """Whether a block after furniture takes up the article again: a sub-heading or running text."""
    return tag in _SUBHEADINGS or len(line) >= RUNNING or bool(_SENTENCE_END.search(line))


def headline(page: Page) -> int:
    """Block index of the headline, -1 without one."""
    lines, n = page.lines, len(page.lines)
    core = title_core(page.title).casefold()
    if core:
        for i in range(n):
            if not page.linked[i] and lines[i].casefold() == core and not _inside(page, page.node[i], _NOT_HEADLINE):
                return i
    # a title that is nothing but the site's name announces no article
    named = not core or page.title.casefold() != f"{core} - {core}"
    for want in ("h1", "big", "h2", "h3") if named else ("h1", "big"):
        for i in range(n):
            if page.linked[i]:
                continue
            if (page.big[i] if want == "big" else page.tag[page.node[i]] == want) and not furniture(lines[i]) and not _inside(page, page.node[i], _NOT_HEADLINE):
                return i
    return -1


def main_box(page: Page, head: int) -> int:
    """Smallest element around the headline that holds more than the headline."""
    node = page.node[head]
    while node > 0 and (page.last[node] - page.first[node] <= 1 or page.tag[node] in ("header", "hgroup", "p") or page.tag[node] in _HEADINGS):
        node = page.parent[node]
    return node


def main_blocks(page: Page) -> list[int]:
    """Indexes of the blocks of the page's own article, in layout order."""
    return with_headline(page)[1]


def with_headline(page: Page) -> tuple[int, list[int]]:
    """(headline or -1, main blocks)."""
    if not page.lines:
        return -1, []
    head = headline(page)
    if head < 0:
        return -1, _densest(page)
    box = main_box(page, head)
    side: dict[int, bool] = {box: False}
    parent, nodes, lines, linked, tags = page.parent, page.node, page.lines, page.linked, page.tag

    def beside(e: int) -> bool:
        s = side.get(e)
        if s is None:
            s = side[e] = beside(parent[e]) or _side(page, e)
        return s

    out = [head]
    after = ""  # closing furniture passed since the article's last block
    held: list[int] = []  # blocks since then that are the article's if it goes on
    for i in range(head + 1, page.last[box]):
        s = lines[i]
        e = nodes[i]
        kind = furniture(s)
        if kind and not (kind in ("footer", "share") and tags[e] in ("td", "li") and e != box):
            if kind in CLOSING and not beside(e):
                if kind == "comments":
                    break
                if kind == "related" or not after:
                    after = kind
            continue
        if linked[i] or beside(e):
            continue
        if box == 0 and tags[e] == "body" and SCRIPT_NOTE.match(s):
            continue
        if after:
            if not _goes_on(s, tags[e]):
                if after != "related":  # else an item of the list of other pages
                    held.append(i)
                continue
            out += held
            held.clear()
            after = ""
        out.append(i)
    return head, out


def _densest(page: Page) -> list[int]:
    """Without a headline: the blocks of the element with most plain text of its own."""
    weight: dict[int, int] = {}
    for i, s in enumerate(page.lines):
        if page.linked[i] or furniture(s) or page.hidden[page.node[i]]:
            continue
        e = page.node[i]
        while e > 0 and page.tag[e] in ("p", "li", "ul", "ol", "blockquote", "tr", "tbody", "table", "dd", "dl", "pre"):
            e = page.parent[e]
        if page.tag[e] not in _SIDE_TAGS:
            weight[e] = weight.get(e, 0) + len(s)
    if not weight:
        return []
    box = max(weight, key=lambda e: (weight[e], -e))
    out = []
    for i in range(page.first[box], page.last[box]):
        e = page.node[i]
        if page.linked[i] or furniture(page.lines[i]) or BAR.match(page.lines[i]) or CRUMB.match(page.lines[i]):
            continue
        while e != box and e > 0 and not _side(page, e):
            e = page.parent[e]
        if e == box:
            out.append(i)
    return out
