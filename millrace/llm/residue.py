"""Template residue, filler and error-page text in the main body of pages.

Method: texts are masked (numbers, addresses, dates, quoted paths) and hashed
exactly; the distributed part (:func:`.pages.messages`) groups the hashes across
hosts and classifies each group. A group is residue by its own evidence (a
placeholder, filler, or the wording of an error message or script notice, by the
rules below), or because it is the whole main body of pages on several hosts:
articles differ from host to host, so a short text that is all there is on many
is a message, whatever its language.

Local part (plain Python on one page): which texts of the body enter the
groups, and with which class.

Defined results: pages without blocks are no case; a page whose visible text is
furniture only is no case; code in ``pre`` is never searched for placeholders;
longer bodies that recur on several hosts are copied articles, no messages.
"""

from __future__ import annotations

import re

import xxhash

from .html import Page
from .mainbody import furniture

_URL = re.compile(r"(?:https?://|www\.)\S+|\S+@\S+\.\w+|(?:/[\w.-]+){2,}", re.I)
_DATE = re.compile(r"\d{1,4}[-/.]\d{1,2}[-/.]\d{1,4}(?:[T ]\d{1,2}:\d{2}(?::\d{2})?)?|\d{1,2}:\d{2}(?::\d{2})?")
_NUM = re.compile(r"\d+(?:[.,]\d+)*")
_GAP = re.compile(r"[\s\W_]+")


def mask(line: str) -> str:
    """Exact normal form: lower case, addresses, dates and numbers masked, punctuation as one blank."""
    s = _URL.sub(" url ", line.lower())
    s = _DATE.sub(" date ", s)
    s = _NUM.sub(" 0 ", s)
    return _GAP.sub(" ", s).strip()


def mask_hash(text: str) -> int:
    """Signed 64-bit hash of a masked text."""
    h = xxhash.xxh64_intdigest(text)
    return h - (1 << 64) if h >= 1 << 63 else h


def group_of(kind: str, text: str) -> int:
    """Hash of the group a text belongs to. Whole bodies and messages meet in one group; masked placeholders and
    filler could look like plain words, so they keep apart."""
    return mask_hash(mask(text) if kind in ("message", "body") else f"{kind}\n{mask(text)}")


#: Usual names of fields: what double underscores hold when they are no emphasis.
_FIELD = (
    "name|title|doctor|city|country|hotline|phone|email|address|date|time|year|price|amount|total|author|body|content|summary|description|link|url|image|user|username"
    "|customer|patient|company|product|item|id|code|number|subject|message|category|tag|slug|site|brand|department"
)
#: Unfilled placeholders of common template languages. Wiki templates with
#: arguments, headings, emphasis, form blanks and references do not match.
PLACEHOLDER = re.compile(
    r"\{\{\s*[\w$.\[\]()|' -]{0,3}[A-Za-z_$][\w.$]*\s*\}\}|\{%-?\s*\w[^%{}]*%\}|<%[=#-]?[^%<>]{1,80}%>|\[%-?[^%\[\]]{1,80}%\]"
    r"|\$\{[A-Za-z_][\w.]*\}|#\{[A-Za-z_][\w.]*\}|@@[A-Za-z_][\w.]*@@|##[A-Za-z_][\w.]*##"
    r"|(?<![\w_])__(?:[A-Za-z]+(?:[._][A-Za-z]+)+|FIELD)__(?![\w_])|(?<![\w%])%[A-Z]{3,}(?:_[A-Z]+)*%(?![\w%])"
    r"|\[(?:Insert|Enter|Your|Nhập|Chèn|请输入|插入)\b[^\[\]]{1,60}\]|\[[A-Z]{3,}(?:[._][A-Z]+)*\](?!\()"
    r"|(?<![\w^_}\\{])\{\d{1,2}\}(?![\w{])|<\?(?:php|=).{0,200}?\?>|\[object [A-Z]\w+\]|(?<![\w.])NaN(?![\w.])"
    r"|\*\|[A-Z][\w:]*\|\*|(?<!\bis )(?<!\bare )(?<!\ban )(?<!\bremains )(?<![\w.-])undefined(?![\w.-])|^(?:null|None|nil|n/?a)$".replace("FIELD", _FIELD)
)
_QUICK = ("{", "*|", "@@", "##", "__", "%>", "<?", "%]", "[Insert", "[Enter", "[Your", "[Nhập", "[Chèn", "[请", "[插", "[object", "NaN", "undefined")
_QUICK_RX = re.compile(r"[%\[][A-Z]{3}")
_EMPTY_RX = re.compile(r"\n(?:null|None|nil|[Nn]/?[aA])\n")

#: Words of the usual Latin filler text, fixed by common usage.
LOREM = frozenset(
    "lorem ipsum dolor sit amet consectetur adipiscing adipisicing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim "
    "ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate "
    "velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est "
    "laborum porro maxime vitae felis ornare porta vestibulum mauris pellentesque curabitur nunc nullam donec vivamus praesent".split()
)
FILLER = re.compile(
    r"(?:just another |this is a |sample )?(?:placeholder|dummy|sample|filler) (?:post|text|page|content|copy)\b|sample page\b"
    r"|(?:your|page|post|main) (?:content|text|copy|headline|paragraph) (?:goes|comes) here|add your (?:paragraph|text|content|headline)"
    r"|(?:replace|edit|change) this (?:text|paragraph|copy|content)|click(?:ing)? (?:here to )?edit\b.{0,20}$|subheading\. body text"
    r"|(?:description|content|details|article|text|summary) (?:is )?coming soon|tbd\b|tba\b|todo\s?:|fixme\s?:|(?:copy|text|content) to be supplied"
    r"|(?:type|enter|write|insert) (?:your )?(?:text|content|description|title) here"
    r"|.{0,20}(?:đoạn văn|tiêu đề|nội dung|văn bản|chú thích) mẫu\b|nhập (?:mô tả|nội dung|tiêu đề|văn bản)\b.{0,40}(?:tại|vào) đây"
    r"|\(?(?:tóm tắt|nội dung|bài viết|mô tả|phần này).{0,20}(?:sẽ được|đang được|đang) (?:bổ sung|cập nhật|hoàn thiện|viết)"
    r"|.{0,30}(?:chèn|thêm) nội dung(?: vào| tại|$)|.{0,20}test thử|.{0,30}\b(?:asdf|qwerty|asdfgh|xxxx+)\b"
    r"|.{0,10}占位(?:符|文字|内容)?$|待(?:补充|完善|更新|编辑)|(?:示例|测试|样例|占位)(?:文字|文本|内容|数据)|请在此(?:处)?(?:输入|填写|添加)|内容(?:更新|建设|整理|编辑)中|敬请期待"
    r"|标题[一1].{0,4}正文[一1]|(?:测试){2,}|(?:此处|这里)(?:是|为|填写|插入)(?:摘要|正文|标题|内容)|暂无(?:内容|简介)",
    re.I,
)
#: A script-requirement notice, as a whole line.
SCRIPTS = re.compile(
    r"(?=.{0,140}$)(?=.*(?:java\s?script(?![a-z])|(?<![a-z])scripts?(?![a-z])|脚本))(?!.*(?:some features|một số tính năng|部分功能))(?=.*(?:enable|turn on|allow|require|need|must|check|support|loading|activate|bật|cần|hỗ trợ|cho phép|kích hoạt|tải"
    r"|启用|打开|需要|支持|开启|允许|加载))",
    re.I,
)
#: An error message or denial, as a whole line.
ERROR = re.compile(
    r"(?:error\s*)?(?:http\s*)?[45]\d\d\s*(?:[-–:]\s*)?(?:not found|forbidden|unauthorized|bad request|bad gateway|gateway time-?out|internal server error|service (?:temporarily )?unavailable|error|gone|too many requests)?\.?$"
    r"|(?:page |file |article )?not found\.?$|bad (?:gateway|request)|gateway time-?out|internal server error|service (?:temporarily )?unavailable|(?:access|permission) (?:is )?denied|forbidden\.?$|unauthori[sz]ed\.?$|too many requests"
    r"|(?:sorry|oops|uh-oh|whoops)\b.{0,80}|something went wrong|an? (?:unexpected |unknown |internal )?(?:server )?error (?:has )?occurred|error establishing a database|database (?:error|connection)|could not connect|connection (?:refused|timed out|reset)"
    r"|(?:this|the|that|requested) (?:\w+ )?(?:page|article|content|post|link|item|resource|url|document)\b.{0,40}(?:no longer|not (?:be )?(?:found|available|exist)|(?:does|did) ?n[o'’]t exist|removed|deleted|moved|expired|unavailable)"
    r"|it may have (?:been )?(?:moved|removed|deleted)|we can[’']?(?:no)?t find|you (?:do not|don[’']t) have (?:permission|access)|(?:your )?session (?:has )?(?:expired|timed out)|please (?:sign|log) in(?: again)?\b|invalid (?:parameter|request|id|argument|token)\b.{0,40}$"
    r"|(?:please )?(?:wait \d+ (?:seconds|minutes)|try again (?:later|in)|come back (?:later|soon))|(?:incident|reference|error|request|trace)(?: (?:id|code|number))?\s*#?\s*:?\s*[\w-]*\d[\w-]*$|upstream |(?:nginx|apache|openresty|cloudflare)(?:[/\s][\d.]+)?$"
    r"|(?:site|system|server) (?:is )?(?:under|down for|undergoing) maintenance|checking your browser|verify (?:that )?you are (?:a )?human|under construction"
    r"|traceback \(most recent call last\)|fatal error\s?:|(?:warning|notice|parse error|deprecated)\s?:\s.{0,160}(?: in /| on line |\(\))|stack trace\s?:|(?:at )?[\w$]+(?:\.[\w$]+){2,}(?:\([\w.]+:\d+\)|Exception|Error)|#\d+ (?:\{main\}|/\S+)|file \"[^\"]+\", line \d+"
    r"|\w*(?:Error|Exception)\s?:\s.{1,160}$|(?:ORA|SQLSTATE|HY\d)[-\[(]"
    r"|(?:trang|liên kết|bài viết|nội dung|đường dẫn|yêu cầu|phiên)\b.{0,40}(?:không (?:tồn tại|tìm thấy|hợp lệ|còn)|đã (?:bị )?(?:xóa|xoá|gỡ|hết (?:hiệu lực|hạn)|di chuyển))|không tìm thấy|lỗi \d{3}|đã (?:xảy ra|có) lỗi"
    r"|(?:hệ thống|máy chủ|website|trang web).{0,20}(?:bảo trì|quá tải|bận|gián đoạn)|(?:xin|vui lòng|mời|hãy) (?:quay lại|thử lại|đăng nhập|liên hệ quản trị)|bạn không có quyền|yêu cầu không hợp lệ|tham số .{0,20}không|số thứ tự chờ|mã (?:sự cố|lỗi)"
    r"|(?:很?抱歉|对不起).{0,40}|(?:页面|网页|文章|内容|链接|该文章|该页面|此页).{0,12}(?:不存在|未找到|已?失效|已?下线|已?删除|已?过期|找不到)|您访问的.{0,30}(?:删除|不存在|移动|下线)|(?:系统|服务器|网络|数据库).{0,12}(?:繁忙|开小差|维护|错误|异常|失败|超时)"
    r"|(?:错误|请求|参考|事件)(?:编号|代码|号)\s?[::]?\s?[\w-]*\d*$|参数错误|访问(?:过于频繁|被拒绝|受限|频率)|(?:登录|会话|登陆)已?(?:超时|过期|失效)|(?:您|你)(?:没有|无)权(?:限)?|没有找到|请(?:稍后|重新|返回首页).{0,20}$|非法请求|无法访问",
    re.I,
)
#: Characters (masked) up to which a body that recurs on several hosts is a message.
MESSAGE_CHARS = 240

#: Messages about the page, the server or the session itself: residue wherever a line of the body starts so.
PLAIN_ERROR = re.compile(
    r"(?:(?:we are |we[’']re )?(?:very )?(?:sorry|oops|uh-oh|whoops)\b\W*(?:but )?|(?:rất tiếc|xin lỗi)\W+|(?:很?抱歉|对不起)\W*)?(?:"
    r"(?:error\s*|http\s*)+[45]\d\d\b(?:\W|$)|[45]\d\d\s*[-–—:|]?\s*(?:page |file )?(?:not found|forbidden|unauthori[sz]ed|bad request|bad gateway|gateway time-?out|internal server error|service (?:temporarily )?unavailable|too many requests|error)\b"
    r"|(?:page|file|article) not found\b|(?:bad gateway|gateway time-?out|service (?:temporarily )?unavailable|(?:access|permission) (?:is )?denied|too many requests|connection (?:refused|timed out|reset(?: by peer)?))\W*$|internal server error"
    r"|something went wrong\W*(?:$|please|try|we|while|on our)|an? (?:unexpected|unknown|internal|server|application)(?: server)? error (?:has )?occurred|an error (?:has )?occurred (?:while|on|in|processing|loading)|error establishing a database|database (?:connection )?error|could not connect to (?:the )?(?:database|server|host)"
    r"|(?:the|this|that) (?:requested )?(?:page|article|content|post|url|document|resource)(?: (?:that )?you(?:[’']re| are| were| have)? (?:requested|looking for|trying to \w+))? (?:is|was|has|could|can|can[’']t|cannot|may|does|did|doesn[’']t)\b.{0,24}\b(?:no longer (?:available|exists?)|found|not available|exist|removed|deleted|moved|unavailable|expired)\b"
    r"|(?:we )?(?:can[’']?(?:no)?t|could(?: not|n[’']t)) (?:find|load) (?:the|this|that) (?:requested )?(?:page|article|content)|you (?:do not|don[’']t) have (?:permission|access) to (?:view|access|see|read|open)|(?:your )?session (?:has )?(?:expired|timed out)"
    r"|please (?:sign|log) in (?:again )?to (?:view|read|continue|see|access)|(?:(?:this|our|the) )?(?:web)?(?:site|system|server) is (?:currently |temporarily )?(?:under|down for|undergoing) maintenance|checking your browser|(?:please )?verify (?:that )?you are (?:a )?human"
    r"|(?-i:[A-Z]\w*(?:Error|Exception)\s?:\s)|(?-i:ORA-\d|SQLSTATE[\[(])"
    r"|(?:trang|liên kết|bài viết|nội dung|đường dẫn)\b(?: này)?(?: (?:mà )?bạn .{0,24}?)? (?:không (?:tồn tại|được tìm thấy|tìm thấy)|(?:hiện )?không còn tồn tại|đã (?:bị )?(?:xóa|xoá|gỡ|hết hạn|di chuyển))|không tìm thấy (?:trang|bài viết|nội dung|đường dẫn)\b"
    r"|lỗi (?:[45]\d\d\b|máy chủ|kết nối (?:máy chủ|cơ sở dữ liệu)|cơ sở dữ liệu)|đã (?:xảy ra|có) lỗi (?:xảy ra|khi|trong quá trình|hệ thống|máy chủ|\W*$)|(?:hệ thống|máy chủ|website|trang web) (?:đang|hiện|tạm)\b.{0,16}(?:bảo trì|quá tải|gián đoạn)"
    r"|bạn không có quyền (?:truy cập|xem)|phiên (?:làm việc|đăng nhập|truy cập)\b.{0,24}hết hạn|(?:vui lòng|hãy) đăng nhập (?:lại )?để (?:xem|đọc|tiếp tục)"
    r"|(?:您(?:访问|请求|查找|浏览)的|该|此)?(?:页面|网页|文章|链接)(?:已?(?:不存在|未找到|失效|下线|被?删除|过期)|找不到)|(?:系统|服务器|网络|数据库)(?:正在|暂时|内部|连接)?(?:繁忙|开小差|维护|错误|异常|失败|超时)"
    r"|参数错误|访问(?:过于频繁|被拒绝|受限)|(?:登录|会话|登陆)已?(?:超时|过期|失效)|(?:您|你)(?:没有|无)权(?:限)?(?:访问|查看)|请(?:先)?登录后(?:查看|阅读|继续)"
    r")",
    re.I,
)
#: A notice that scripts are needed, in a line of any length.
PLAIN_SCRIPTS = re.compile(
    r"(?:enable|turn on|activate|allow|switch on) (?:java\s?script|scripts)\b|\bjava\s?script (?:(?:is|must be|needs to be|has to be|should be|seems to be|appears to be) (?:currently )?)?(?:required|disabled|enabled|turned o(?:n|ff)|switched o(?:n|ff)|needed|not (?:enabled|supported|available))"
    r"|(?:requires?|needs?|without|support) java\s?script\b|(?:bật|kích hoạt|cho phép|yêu cầu|cần|hỗ trợ) (?:chạy |dùng |có )?java\s?script"
    r"|(?:启用|打开|开启|允许|需要|支持).{0,8}(?:java\s?script|脚本)|(?:java\s?script|脚本).{0,8}(?:启用|打开|开启|禁用|关闭|不可用)",
    re.I,
)
_SOME_FEATURES = re.compile(r"some (?:features|functions|parts)|certain features|một số tính năng|部分功能", re.I)


def has_placeholder(line: str) -> bool:
    return bool(PLACEHOLDER.search(line))


def is_filler(line: str) -> bool:
    """Latin filler by share of its words, or a phrase that announces text to come."""
    if FILLER.match(line):
        return True
    if line.isascii():
        words = re.findall(r"[a-z]+", line.lower())
        return len(words) >= 2 and sum(w in LOREM for w in words) * 10 >= 8 * len(words)
    return False


#: Substrings (lower case) without which no line can be filler.
_FILLER_HINTS = (
    "ipsum", "lorem", "porro", "amet", "elit", "consectetur", "dolor", "maxime", "vitae", "nulla", "quis", "ornare", "velit",
    "placeholder", "dummy", "sample", "filler", " here", "your ", "edit", "body text", "coming soon", "tbd", "tba", "todo", "fixme", "supplied",
    " mẫu", "nhập ", "bổ sung", "cập nhật", "hoàn thiện", "đang viết", "chèn", "thêm nội", "test thử", "asdf", "qwerty", "xxxx", "placeholder",
    "占位", "待补充", "待完善", "待更新", "待编辑", "示例", "测试", "样例", "请在此", "内容更新", "内容建设", "内容整理", "内容编辑", "敬请期待", "标题", "此处", "这里", "暂无",
)


def _code(page: Page, i: int) -> bool:
    e = page.node[i]
    while e > 0:
        if page.tag[e] == "pre":
            return True
        e = page.parent[e]
    return False


def message_line(line: str) -> bool:
    """Whether a whole line is an error message, a denial or a script notice."""
    return bool(ERROR.match(line) or SCRIPTS.match(line))


def plain_message(line: str) -> bool:
    """Whether a line is a message that no running article holds, however many lines stand around it."""
    if PLAIN_ERROR.match(line) or _TRACE.match(line):
        return True
    low = line.lower()
    return ("script" in low or "脚本" in low) and bool(PLAIN_SCRIPTS.search(line)) and not _SOME_FEATURES.search(line)


def _unfinished(page: Page, body: list[int]) -> tuple[str, str]:
    """(class, text) of the first block of the body with a placeholder or filler."""
    lines = page.lines
    joined = "\n".join([lines[i] for i in body])
    if any(map(joined.__contains__, _QUICK)) or ("%" in joined or "[" in joined) and _QUICK_RX.search(joined) or _EMPTY_RX.search(f"\n{joined}\n"):
        for i in body:
            if has_placeholder(lines[i]) and not _code(page, i):
                return "placeholder", lines[i]
    low = joined.lower()
    if any(map(low.__contains__, _FILLER_HINTS)):
        for i in body:
            s = lines[i]
            if is_filler(s) and not _code(page, i):
                return "filler", s
    return "", ""


#: Classes that make a page a case however often their text occurs.
SURE = frozenset(["placeholder", "filler", "message"])


def judge(page: Page, body: list[int], head: int) -> tuple[str, str]:
    """(class, the text that shows it); ``("", "")`` for a page whose body enters no group.

    Classes are those of :data:`SURE` and ``body``: a body short enough to be a
    message that must recur to be one. ``body`` are the main blocks of the page,
    ``head`` its headline or -1. A message counts wherever it stands in the
    body; looser wording counts where at least half of the lines are so worded.
    """
    lines = page.lines
    if head < 0 and not body:
        # no article: whatever visible text is not worded like furniture
        body = [i for i in range(len(lines)) if not page.linked[i] and not furniture(lines[i])]
    if not body:
        return "", ""
    found = _unfinished(page, body)
    if found[0]:
        return found
    if head < 0:
        for i in range(len(lines)):
            if not page.linked[i] and message_line(lines[i]) and not furniture(lines[i]):
                return "message", lines[i]
    for i in body:
        if plain_message(lines[i]) and not _code(page, i):
            return "message", lines[i]
    others = len(body) // 2  # so many lines may be worded otherwise
    for i in body:
        others -= not message_line(lines[i])
        if others < 0:
            break
    else:
        return "message", "\n".join([lines[i] for i in body])
    size = -1
    for i in body:
        size += len(mask(lines[i])) + 1
        if size > MESSAGE_CHARS:
            return "", ""
    return "body", "\n".join([lines[i] for i in body])


#: Program output that is residue wherever it stands.
_TRACE = re.compile(
    r"traceback \(most recent call last\)|fatal error\s?:|(?:warning|notice|parse error)\s?:\s.{0,160}(?: in /.{1,120} on line |\w+\(\)\s?:)|error establishing a database connection", re.I
)
