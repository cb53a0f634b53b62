"""Abusive, hateful and sexually explicit language in documents.

Method: Levenshtein automata intersected with a lexicon trie. Each distinct
token, after disguises are undone (zero-width and inserted characters, digits
for letters, look-alike letters, drawn-out letters), walks the trie of lexicon
words together with the states of its Levenshtein automaton (neighbouring
letters in the wrong order are one error). A token of any length that is no word
of its own is read as the lexicon word next to it: one error from three letters
on, two from nine. Below six letters such a reading only counts inside a phrase
of several words. Terms in ideographs walk a trie of their own, in which a
character also stands for one that sounds alike. Masked letters match any one
inside the rules, so no reading is left out.

Sentences are rewritten with the lexicon words found and scored: terms that
attack, degrade or arouse add to their category, and the context window of a
term (quoting, warning, medical or educational wording around it) takes away.
Words in quotation marks beside a word of speech are another's, not the author's.

Defined results: null, empty and blank texts score 0 and have no category;
repeated sentences do not add up, a document has the score of its worst
sentence; a sentence that degrades a group is hateful and its insults are not
counted as abuse of a person.
"""

from __future__ import annotations

import json
import os
import re
import re._parser as sre
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship, spread
from .language import fold
from .tokens import TOKENIZERS, VOCABULARY

THRESHOLD = 1.0
CATEGORIES = ("abusive", "hateful", "sexual")

# ------------------------------------------------------------ lexicon (fixed values)
# Alternatives are words or phrases; a category's pattern gives its weight.
_V_INSULT = "óc chó|ngu như bò|ngu|mất dạy|khốn nạn|rác rưởi|cặn bã|vô học|đê tiện|đần độn|đần|súc vật|chó má|hèn hạ|bỉ ổi|vô lại|rác|bã đậu|cứt|ngu xuẩn|láo toét|lừa đảo|khùng|điên"
_V_HEAD = "thằng|con mụ|con mẹ|mụ|lũ|đồ|cái loại|cái thứ|quân|bọn|mày|đứa|tên|cái đồ"
_V_GROUP = (
    "ngụ cư|nhập cư|miền núi|người già|ngoại quốc|tị nạn|người tàn tật|tàn tật|khuyết tật|đàn bà|phụ nữ|dân tộc|da đen|đồng tính|người nước ngoài|di dân|ngoại tỉnh"
    "|ăn xin|nhà quê|miền bắc|miền nam|miền tây|đạo hồi|do thái|chuyển giới|vô gia cư"
)
_V_LOW = "sâu bọ|súc vật|bẩn thỉu|mọi rợ|ký sinh trùng|hạ đẳng|rác rưởi|cặn bã|giòi bọ|dịch bệnh|thấp kém|chuột bọ|côn trùng"
_E_GROUP = (
    "immigrants|migrants|foreigners|lowlanders|highlanders|hill people|mountain people|disabled people|the disabled|cripples|asylum seekers|refugees|women doctors|female doctors|lady doctors"
    "|old people|the elderly|gays|homosexuals|transgender people|muslims|jews|blacks|gypsies|minorities|beggars|the homeless|homeless people|ethnic people|natives|outsiders|villagers|peasants"
)
_E_LOW = "filth|filthy|vermin|parasites|parasite|animals|scum|a disease|subhuman|subhumans|less than human|inferior|rats|cockroaches|pests|trash|garbage|dirt|savages|barely human|plague"
_E_WORST = "filth|filthy|vermin|parasites|scum|subhuman|subhumans|less than human|cockroaches|savages|barely human|not human|a disease"
_E_INSULT = (
    "idiot|idiots|moron|morons|imbecile|cretin|bastard|bastards|scumbag|loser|losers|liar|fool|prick|quack|piece of trash|piece of shit|asshole|bitch|jerk|dumbass|pig|clown|creep|dimwit|fraud|halfwit|retard|crook|charlatan|twit|worm|coward"
)
#: People by where they are from or what they are, as plurals.
_E_PEOPLE = r"\w+(?:ians|eans|icans|ese|ish people|ish women|ish men)|(?:the |these |those )?\w+ (?:people|women|men|folk|immigrants|migrants|refugees|families)"
_E_BAD = "useless|worthless|pathetic|disgusting|brain dead|braindead|filthy|spineless|stupid|dumb|complete|utter|damn|fucking|miserable|rotten|brainless|ignorant|clueless|vile|bloody|lying|dirty"
_Z_INSULT = "脑残|智障|白痴|废物|垃圾|骗子|蠢货|畜生|王八蛋|傻逼|傻子|贱人|混蛋|人渣|败类|狗东西|杂种|笨蛋|猪脑子|下贱|狗屎|蠢猪|饭桶|渣滓|神经病"
_Z_GROUP = "女医生|移民|难民|残疾人|老不死的|山里人|外地人|乡下人|老年人|老人|女人|黑人|同性恋|少数民族|外国人|残废|农民工|穆斯林|犹太人|乞丐|流浪汉|低端人口|瘸子|聋子|瞎子|农村人"
_Z_LOW = "害虫|低等|劣等|垃圾|畜生|又脏又蠢|寄生虫|蛆|蟑螂|浪费粮食|臭虫|下等|渣滓|不配|肮脏|老鼠|牲口|贱种"


def _p(*rules: tuple[float, str]) -> list[tuple[float, str]]:
    return list(rules)


_VI = {
    "abusive": _p(
        (1.0, rf"(?:{_V_HEAD})(?: bác sĩ| y tá| kia| này| viết bài| thầy thuốc| điều dưỡng| tác giả)? (?:{_V_INSULT})(?! quốc| gia)"),
        (1.0, rf"mày (?:đúng là|là|chỉ là|quá|thật) (?:\w+ )?(?:{_V_INSULT})"),
        (1.0, r"câm mồm|câm miệng|tao (?:mà )?gặp mày|tao (?:sẽ )?(?:đập|giết|chém|đánh|đấm)|đập vỡ m\w+|mày biết gì mà nói|đầu óc mày|mới tin mày|tin mày"),
        (1.0, rf"viết như (?:{_V_INSULT})|(?:{_V_INSULT}) (?:lừa đảo )?(?:cút|chết) đi|(?:đồ|lũ|thằng) \w+(?: \w+)? (?:cút|chết) đi|đúng là (?:đồ )?(?:ngu|óc chó|vô học|đê tiện|mất dạy|khốn nạn|đần|rác rưởi|cặn bã)"),
        (0.6, r"mày|tao|cút đi|chết đi|cút xéo|biến đi"),
        (0.5, rf"(?:{_V_INSULT})"),
    ),
    "hateful": _p(
        (1.0, rf"(?:{_V_GROUP})(?: làm bác sĩ)? (?:\w+ ){{0,2}}(?:là|toàn|thì|như|đúng là) (?:\w+ ){{0,2}}(?:{_V_LOW})"),
        (1.0, rf"(?:{_V_GROUP})(?: làm bác sĩ)? chỉ tốn cơm|không đáng sống|(?:nhìn|thấy) (?:bọn |dân |đám |lũ |con )?(?:{_V_GROUP})(?: làm bác sĩ)? là thấy (?:bẩn|ghê|ghét)"),
        (1.0, rf"thế giới (?:này )?sẽ (?:sạch|tốt|đẹp) hơn nếu không có|không khám cho (?:bọn |dân |đám |lũ |con )?(?:{_V_GROUP})|(?:xóa sổ|xoá sổ|đuổi|nhốt|tống cổ|tiêu diệt|giết) hết"),
        (0.6, rf"(?:bọn|đám|lũ|dân|quân) (?:{_V_GROUP})"),
        (0.5, rf"(?:{_V_LOW})"),
    ),
    "sexual": _p(
        (1.0, r"phim sex|clip sex|phim (?:cấp ba|người lớn|khiêu dâm)|clip làm tình|nứng|chat cam|kích dục|gái gọi|rên rỉ|tụt quần|quay lén|thủ dâm cho|phục vụ tận giường|bóp (?:ngực|vú)|liếm khắp|cởi hết|thọc tay vào|cưỡi lên (?:bụng|người)|show hàng|lộ hàng|bú cu|bú lồn|địt|đụ|sướng lồn|cặc"),
        (0.5, r"làm tình|khỏa thân|không che|hot girl|gái xinh|em gái mưa|chị hàng xóm|18\+|bao phê|không giới hạn|nhắn tin là có|quần lót|cả đêm|nóng bỏng|trần truồng"),
    ),
}
_EN = {
    "abusive": _p(
        (1.0, rf"(?:you|your|yourself)\b.{{0,40}}\b(?:{_E_INSULT})\b(?! is not tolerated)|(?:{_E_INSULT})\b,? (?:you|did you|are you|get out|go)\b|(?:{_E_INSULT})\b.{{0,12}}\b(?:you|your)\b"),
        (1.0, rf"(?:shut up|go (?:drown|hang|kill|die)\w*|drop dead|people like you deserve|deserve to rot|i hope you (?:choke|die|rot|suffer|get)|i will (?:find|kill|break|hurt|beat|burn) you|break your (?:teeth|legs|neck|face|arms)|burn in hell|rot in hell|screw you|fuck you|get lost|kill yourself|kys\b)"),
        (1.0, r"(?:someone|somebody|i|we|they) (?:should|will|ought to|must|am going to|are going to|m going to) (?:kill|shoot|stab|strangle|hang|hurt|beat up) (?:you|him|her|them)\b|burn (?:your|his|her|their) (?:house|home|clinic|office|car)\b|i know where you live"),
        (1.0, rf"(?:is|was|are|such|what) an? (?:(?:{_E_BAD}) )+(?:{_E_INSULT})|what an? (?:\w+ )?(?:\w+ )?(?:{_E_INSULT})|only an? (?:\w+ ){{0,2}}(?:{_E_INSULT}) would|believe this quack|(?:{_E_BAD}|lying|wrong|stupid) as ever|is (?:crap|shit|garbage) and so are you|so are you\b|you are an? (?:{_E_BAD}|{_E_INSULT})|you (?:{_E_BAD}) (?:{_E_INSULT}|piece|pile|waste)|did you buy your degree|whoever wrote this"),
        (0.5, rf"\b(?:{_E_INSULT}|crap|drivel|shit|bullshit)\b"),
        (0.4, r"\byou\b|\byour\b"),
    ),
    "hateful": _p(
        (1.0, rf"(?:{_E_GROUP}) (?:are|is|were|remain) (?:all |just |nothing but |like |worse than |no better than |a kind of |only )*(?:{_E_LOW})"),
        (1.0, rf"(?:{_E_GROUP}) (?:do not|does not|don t|never) deserve|without (?:the |those |these )?(?:{_E_GROUP})|send (?:the |those |these )?(?:{_E_GROUP}) (?:back|home|away)|keep (?:the |those |these )?(?:{_E_GROUP}) out|get rid of (?:the |those |these |all )?(?:{_E_GROUP})|no treatment for (?:the )?(?:{_E_GROUP})"),
        (1.0, rf"(?:{_E_GROUP}) (?:\w+ ){{0,3}}like (?:rats|vermin|animals|cockroaches|pigs|flies|rabbits)|(?:{_E_GROUP}) breed\b|refuse to \w+ (?:near|next to|beside|with) (?:{_E_GROUP})|(?:{_E_GROUP}) (?:{_E_LOW}) (?:all|every one) of them"),
        (1.0, rf"every one of (?:those|these|the) (?:{_E_GROUP})|(?:{_E_GROUP})\b.{{0,40}}\bshould be (?:driven|wiped|locked|shot|burned|burnt|sterili|expelled|removed|kept out|put down|rounded|left to)|(?:{_E_GROUP})\b.{{0,60}}\b(?:{_E_WORST})\b|(?:{_E_WORST})\b.{{0,40}}\b(?:{_E_GROUP})\b"),
        (1.0, rf"(?:{_E_PEOPLE}) (?:are|were) (?:all |just |nothing but |like |worse than |no better than |only )*(?:filth|vermin|scum|subhuman|subhumans|less than human|cockroaches|savages|barely human|not human)|(?:{_E_PEOPLE}) (?:\w+ ){{0,6}}should be (?:shot|gassed|exterminated|wiped out|hanged|sterili[sz]ed|burned|burnt)"),
    ),
    "sexual": _p(
        (1.0, r"wet pussy|\bpussy\b|sex videos?|cam girls?|nude cams?|adult escorts?|escorts\b|hardcore|uncensored|\bhorny\b|porn\w*|xxx\b|went down on (?:him|her|me)|rode (?:him|her|me)|got hard while|send me your nudes|talk dirty|licked (?:his|her|my)|strip(?:s|ped)? (?:and|off|for)|cams? all night|blow ?job|cum\w*\b|fuck(?:ed|ing) (?:her|him|me)|suck(?:ed|ing) (?:his|her|my)|moan(?:ed|ing)|naked (?:girls?|women|teens?)|hot (?:girls?|singles|teens?) |explicit (?:adult|videos?)|want you tonight|(?:nude|naked|dirty|horny|explicit) (?:strippers|housewives|singles|girls|escorts|students|models|teens)"),
        (0.5, r"\bnudes?\b|\bnaked\b|\bstrippers?\b|\bexplicit\b|want you tonight|tonight|18\+|full service|first hour free|no limits|thighs|\bsexy\b|click for|housewives|\bsingles\b|\bdirty\b|waiting for you|watch\b"),
    ),
}
_ZH = {
    "abusive": _p(
        (1.0, rf"(?:你|你们|你这个|你就是个?|全家|写文章的人?|作者|医生).{{0,8}}(?:{_Z_INSULT})|(?:{_Z_INSULT}).{{0,4}}(?:去死|滚|才信你|医生|别出来)|(?:闭嘴|滚蛋|滚开|去死|找死).{{0,4}}(?:{_Z_INSULT})"),
        (1.0, r"去死吧|去死|吃屎|脑子(?:有坑|进屎|进水|有病|坏了)|不要脸|瞎了狗眼|狗眼|见你一次打一次|打死你|弄死你|砍死你|闭嘴吧|滚蛋|操你|草泥马|他妈的|你妈|不得好死|别出来害人|全家都是|全家死"),
        (0.5, rf"(?:{_Z_INSULT})|恶心的"),
    ),
    "hateful": _p(
        (1.0, rf"(?:{_Z_GROUP}).{{0,10}}(?:{_Z_LOW})|(?:{_Z_GROUP}).{{0,10}}(?:滚出|消灭|关起来|赶出|去死|该死|统统)"),
        (1.0, rf"看见(?:{_Z_GROUP})就(?:恶心|烦|讨厌)|(?:没有|除掉|赶走|消灭)(?:{_Z_GROUP}).{{0,10}}(?:干净|更好)|(?:不给|拒绝给)(?:{_Z_GROUP})|把(?:{_Z_GROUP}).{{0,6}}(?:赶走|绝育|消灭|关起来|赶出|清除|杀)"),
    ),
    "sexual": _p(
        (1.0, r"做爱|口交|自慰给|裸聊|叫床|无码|淫荡|嫩模|包夜|约炮|骚货|成人激情|激情直播|舔遍|扒下.{0,4}内裤|脱光衣服|上门全套|全套服务|来操|偷拍视频|骑在.{0,3}身上|呻吟|色情|三级片|黄片|肉棒|乳交|群交|援交|一夜情"),
        (0.5, r"学姐|少妇|美女|免费看|在线|加我私聊|全程无套|高清|直播|内裤|裸"),
    ),
}
#: Wording that quotes, condemns or warns; near a term it takes its score down.
_CONTEXT = {
    "vi": r"kỳ thị|lên án|xúc phạm|những từ như|các từ như|từ ngữ|đề nghị (?:không|các)|nhấn mạnh|phân biệt đối xử|cảnh báo|là loại hạt|thường gặp|không được gọi|bị gọi là",
    "en": r"reminds?|not tolerated|hate speech|harms|warns?|condemn\w*|discriminat\w*|stigma\w*|authors|according to|reported|insults?|words (?:such|like)|was called|were called|so called",
    "zh": r"请勿|辱骂|等词|提醒|歧视|谴责|报道|倡议|尊重|反对|分类处理|被骂|禁止",
}
#: Medical and educational wording; near a term it takes the sexual score down.
_MEDICAL = {
    "vi": r"nhiễm nấm|lây truyền|sinh dục|phòng bệnh|bao cao su|giáo dục|khí hư|âm đạo|tự khám|lành mạnh",
    "en": r"infections?|condoms?|sexual health|self examination|mirror|erectile|complaints|contracept\w*|consent|breast",
    "zh": r"自检|自查|就诊|出血|感染|避孕|健康教育|乳房|阴道",
}
#: Letters from which two neighbours in the wrong order count by themselves, from which any one error does,
#: and from which two errors are tried. Shorter readings count inside phrases.
SHORT_LENGTH, PLAIN_LENGTH, LONG_LENGTH = 4, 6, 9
#: Words of their own that such a change would turn into a lexicon word.
PLAIN_WORDS = frozenset("shingles form from trial trail angle angel lair lira arts tars tsar salve untied united sacred scared causal casual dairy diary silver sliver quiet quite calm clam rats brid bird gril girl wrap warp sued used".split())
#: Words of the rules that mean nothing by themselves: no token is read as one of them.
FUNCTION_WORDS = frozenset(
    "the than they them those these that this what your you yourself with without from such like just only hope know live should ought no so to my an him her his he she in of and or go it is are was were be as for on at by not all"
    " every one who so did do does don they we me more than who why any back out off down get got have has had must will would want near next beside there their nothing but kind would".split()
)
#: Characters on either side of a term that count as its context.
WINDOW = 60
CONTEXT_PRICE = 1.2
#: What is taken off the score of quoted words beside a word of speech.
QUOTE_PRICE = 2.5
# ------------------------------------------------------------------------- cleaning
_INVISIBLE = re.compile("[­​-‏⁠-⁤﻿‪-‮]")
# Letters of other scripts that look like Latin ones, fixed by their shapes.
_LOOKALIKE = str.maketrans("аеорсухіјѕһԁԛѡкмтвнАЕОРСУХІЈЅКМТВНαοεικρτυνΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeopcyxijshdqwkmtbhAEOPCYXIJSKMTBHaoeikptuvABEZHIKMNOPTYX")
_OTHER_SCRIPT = re.compile("[\u0370-\u052f]")
_LEET = str.maketrans("013457@$", "oieastas")
_DOTTED = re.compile(r"(?<![^\W\d_])[^\W\d_](?:[.·•_-][^\W\d_]){2,}(?![^\W\d_])\.?")
_DRAWN = re.compile(r"([^\W\d_])\1{2,}")
_TOKEN = re.compile(r"[^\W_]+(?:\*+[^\W_]*)*|\*+[^\W_]+(?:\*+[^\W_]*)*|18\+")
_SENTENCE = re.compile(r"[\n\r\u0085  。]+|(?<=[.!?！？])\s+")
_WIDE = re.compile("[㐀-鿿]")
_NOT_WIDE = re.compile("[^㐀-鿿]+")
_VN_MARK = re.compile("[ăâđêôơưàáảãạằắẳẵặầấẩẫậèéẻẽẹềếểễệìíỉĩịòóỏõọồốổỗộờớởỡợùúủũụừứửữựỳýỷỹỵ]")


class Trie:
    """Lexicon words by letter; search with a Levenshtein automaton."""

    def __init__(self, words: list[str]) -> None:
        self.root: dict = {}
        for w in words:
            node = self.root
            for c in w:
                node = node.setdefault(c, {})
            node[""] = w

    def within(self, token: str, most: int) -> str | None:
        """The closest lexicon word at distance ``most`` or less; ``*`` matches any letter.

        Ties go to the word first in letter order.
        """
        return min(self.all_within(token, most), default=(0, None))[1]

    def all_within(self, token: str, most: int) -> list[tuple[int, str]]:
        """(distance, word) of every lexicon word at distance ``most`` or less; two neighbours in the wrong order are one error."""
        n = len(token)
        full = (1 << n + 1) - 1
        any_ = sum(1 << i for i, t in enumerate(token) if t == "*")
        masks: dict[str, int] = {}
        for i, t in enumerate(token):
            masks[t] = masks.get(t, any_) | 1 << i
        found: list[tuple[int, str]] = []
        # the automaton's state: for each number of errors the positions of the token reached, as bits;
        # kept with the state and letter before for letters in the wrong order
        first = [(1 << k + 1) - 1 & full for k in range(most + 1)]
        stack = [(self.root, first, None, 0)]
        while stack:
            node, row, earlier, last = stack.pop()
            word = node.get("")
            if word is not None:
                for k, reached in enumerate(row):
                    if reached >> n:
                        found.append((k, word))
                        break
            for c, child in node.items():
                if c == "":
                    continue
                m = masks.get(c, any_)
                fewer = (row[0] & m) << 1
                new = [fewer]
                for k in range(1, most + 1):
                    r = row[k - 1]
                    fewer = (row[k] & m) << 1 | r | r << 1 | fewer << 1
                    if earlier is not None:
                        fewer |= (earlier[k - 1] & m & last >> 1) << 2
                    fewer &= full
                    new.append(fewer)
                if fewer:
                    stack.append((child, new, row, m))
        return found


def required(pattern: str) -> frozenset[str]:
    """Texts of which at least one stands in whatever the pattern matches; empty where none can be told."""

    def of(items) -> frozenset[str]:
        options: list[frozenset[str]] = []
        run = ""
        for op, arg in [*items, (None, None)]:
            if op is sre.LITERAL:
                run += chr(arg)
                continue
            if run:
                options.append(frozenset([run]))
                run = ""
            inner: frozenset[str] = frozenset()
            if op is sre.SUBPATTERN:
                inner = of(arg[-1])
            elif op is sre.BRANCH:
                parts = [of(b) for b in arg[1]]
                inner = frozenset().union(*parts) if all(parts) else inner
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0]:
                inner = of(arg[2])
            if inner:
                options.append(inner)
        return max(options, key=lambda o: (min(map(len, o)), -len(o)), default=frozenset())

    found = of(sre.parse(pattern))
    return frozenset(t for t in found if not any(o != t and o in t for o in found))


def masked(pattern: str) -> str:
    """The rule for sentences with masked letters: each of its letters also matches a ``*``, which counts as a letter."""
    out: list[str] = []
    i = 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            i += 1
            c = pattern[i]
            out.append({"w": r"[\w*]", "b": r"(?:(?<![\w*])(?=[\w*])|(?<=[\w*])(?![\w*]))"}.get(c, "\\" + c))
        elif c == "{":
            end = pattern.index("}", i)
            out.append(pattern[i : end + 1])
            i = end
        elif c == "[":
            end = pattern.index("]", i)
            out.append(pattern[i:end] + ("]" if pattern[i + 1] == "^" else "*]"))
            i = end
        else:
            out.append(f"[{c}*]" if c.isalpha() else c)
        i += 1
    return "".join(out)


#: A Vietnamese syllable, written with or without marks: a word of its own, not a misspelling.
_SYLLABLE = re.compile(r"(?:ngh|ng|nh|gh|gi|kh|ph|qu|th|tr|ch|[bcdghklmnprstvx])?[aeiouy]{1,3}(?:ng|nh|ch|[cmnpt])?")


@lru_cache(maxsize=1)
def ordinary_words() -> frozenset[str]:
    """Whole lower-case words of the public vocabulary, and a few that it lacks; only the latter where there is no such file."""
    path = os.path.join(TOKENIZERS, VOCABULARY)
    if not os.path.exists(path):
        return PLAIN_WORDS
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    return PLAIN_WORDS | {t[1:] for t in vocabulary if t[0] == "Ġ" and t[1:].isalpha()}


class Scorer:
    """Patterns and lexicon of one spelling (accented or not) of one language."""

    def __init__(self, rules: dict[str, list[tuple[float, str]]], language: str, change, divided: bool = True) -> None:
        edge = (r"(?<!\w)", r"(?!\w)") if divided else ("", "")  # ideographs are not divided into words
        whole = {c: [(w, f"{edge[0]}(?:{change(p)}){edge[1]}") for w, p in ps] for c, ps in rules.items()}
        #: (category, weight, rule)
        self.rules = [(c, w, re.compile(p)) for c, ps in whole.items() for w, p in ps]
        self.masked = [(c, w, re.compile(masked(p) if divided else p)) for c, ps in whole.items() for w, p in ps]
        #: texts without which a rule cannot match, all looked for in one pass; each stands for a set of rules
        self.keys = [required(p) for ps in whole.values() for _, p in ps]
        sets: dict[str, int] = {}
        for i, texts in enumerate(self.keys):
            for t in texts:
                sets[t] = sets.get(t, 0) | 1 << i
        self.screen = ahocorasick.Automaton()
        for t, rules_ in sets.items():
            self.screen.add_word(t, rules_)
        self.screen.make_automaton()
        self.always = sum(1 << i for i, texts in enumerate(self.keys) if not texts)
        self.context = re.compile(change(_CONTEXT[language]))
        self.medical = re.compile(change(_CONTEXT[language] + "|" + _MEDICAL[language]))
        words = {w for ps in rules.values() for _, p in ps for w in re.findall(r"[^\W\d_]+", change(re.sub(r"\(\?\w*[:!=<]|\\[a-z]|\{[^}]*\}", " ", p))) if len(w) > 1}
        self.words = frozenset(words)
        self.trie = Trie(sorted(words - FUNCTION_WORDS))
        self.language = language
        #: tokens looked up, those read as another word, and those whose loose reading is yet another
        self.known: set[str] = set()
        self.strict: dict[str, str] = {}
        self.loose: dict[str, str] = {}

    def own_word(self, token: str) -> bool:
        """Whether a token is a word of its own, lexicon or not."""
        if self.language == "vi":
            return bool(_SYLLABLE.fullmatch(fold(token))) or token in ordinary_words()
        return not token.isascii() or token in ordinary_words()

    def look_up(self, token: str) -> None:
        """Fill both caches with the lexicon words a token stands for, or the token itself.

        The strict reading counts by itself, the loose one (short tokens, two errors) inside phrases only.
        """
        strict = loose = token
        n = len(token)
        if token not in self.words and "*" not in token and token.isalpha() and n >= 3 and not self.own_word(token):
            near = self.trie.within(token, 2 if n >= LONG_LENGTH else 1)
            if near is not None:
                loose = near
                if n >= SHORT_LENGTH and (sorted(near) == sorted(token) or n >= PLAIN_LENGTH and (n < LONG_LENGTH or self.trie.within(token, 1) == near)):
                    strict = near
        if len(self.known) > 300_000:
            self.known.clear()
            self.strict.clear()
            self.loose.clear()
        self.known.add(token)
        if strict != token:
            self.strict[token] = strict
        if loose != strict:
            self.loose[token] = loose

    def readings(self, tokens: list[str]) -> tuple[str, str]:
        """The sentence in lexicon words, strictly and loosely; masked tokens stay masked, for rules that take ``*`` for any letter."""
        words = set(tokens)
        for t in words - self.known:
            self.look_up(t)
        line = " ".join(tokens) if self.strict.keys().isdisjoint(words) else " ".join([self.strict.get(t, t) for t in tokens])
        if self.loose.keys().isdisjoint(words):
            return line, line
        return line, " ".join([self.loose.get(t) or self.strict.get(t, t) for t in tokens])

    def misspelled(self, tokens: list[str]) -> bool:
        """Whether a token with a loose reading is no syllable of the Vietnamese text around it."""
        return any(t in self.loose and not _SYLLABLE.fullmatch(t) for t in tokens)

    def phrases(self, sentence: str) -> list[tuple[str, int, int]]:
        """(category, first word, last word) of what the rules for masked text match over several words."""
        found = []
        for c, _, rx in self.masked:
            for m in rx.finditer(sentence):
                first, last = sentence.count(" ", 0, m.start()), sentence.count(" ", 0, m.end())
                if last > first:
                    found.append((c, first, last))
        return found

    def score(self, sentence: str, phrases: list[tuple[str, int, int]] = [], alone: bool = True, several: bool = False, outside: bool = True) -> dict[str, float]:  # noqa: B006
        """Score by category. A masked word that a phrase of ``phrases`` explains is no word of another category by itself,
        and without ``alone`` masked words count in phrases only. With ``several`` only matches of several words count, and
        ``outside`` says that the words are the author's own."""

        def free(c: str, m: re.Match[str]) -> bool:
            if " " in m.group(0):
                return True
            if several:
                return False
            if "*" not in m.group(0):
                return True
            if not alone:
                return False
            at = sentence.count(" ", 0, m.start())
            return not any(k != c and first <= at <= last for k, first, last in phrases)

        hidden = "*" in sentence
        hit = self.always
        if hidden:
            hit = (1 << len(self.rules)) - 1
        else:
            for _, rules in self.screen.iter(sentence):
                hit |= rules
        if not hit:
            return {}
        every = self.masked if hidden else self.rules
        plain = not (phrases or several) and alone
        total: dict[str, list] = {}
        while hit:
            low = hit & -hit
            hit ^= low
            c, w, rx = every[low.bit_length() - 1]
            m = rx.search(sentence) if plain else next((m for m in rx.finditer(sentence) if free(c, m)), None)
            if m:
                x = total.setdefault(c, [0.0, len(sentence), 0])
                x[0] += w
                x[1], x[2] = min(x[1], m.start()), max(x[2], m.end())
        out = {}
        for c, (v, first, last) in total.items():
            near = sentence[max(0, first - WINDOW) : last + WINDOW]
            if (self.medical if c == "sexual" else self.context).search(near):
                v -= CONTEXT_PRICE
            out[c] = v if outside else v - QUOTE_PRICE
        return out


@lru_cache(maxsize=1)
def scorers() -> dict[str, Scorer]:
    same = lambda p: p
    # without marks, single syllables mean too much else: they count in phrases only
    plain = {
        "abusive": [r for r in _VI["abusive"] if r[0] >= THRESHOLD],
        "hateful": _VI["hateful"],
        "sexual": [(w, p.replace("|địt|đụ|sướng lồn|cặc", "")) for w, p in _VI["sexual"]],
    }
    return {
        "vi": Scorer(_VI, "vi", same),
        "va": Scorer(plain, "vi", fold),
        "en": Scorer(_EN, "en", same),
        "zh": Scorer(_ZH, "zh", same, divided=False),
    }


# ------------------------------------------------------------------ ideographs
# Traditional forms of lexicon characters, and characters that sound like the first of each group.
_SIMPLE = str.maketrans("殘癡廢騙貨賤雜種豬腦滾閉媽們這個蟲髒碼難無婦幹雞", "残痴废骗货贱杂种猪脑滚闭妈们这个虫脏码难无妇干鸡")
_SOUNDS = "残惨蚕 痴吃持池 障帐杖丈 智志制知 废费肥 物务勿 垃拉喇 圾级极及 蠢春纯 货祸 畜触 傻煞沙啥 逼比笔币批 贱剑 混浑 蛋旦弹 渣扎咋 狗苟 杂咂 种肿 猪朱诸 脑恼 滚衮 人仁 骗偏".split()


class SoundTrie:
    """Terms in ideographs, read with at most one character that only sounds right."""

    def __init__(self, terms: list[str]) -> None:
        self.root = Trie(terms).root
        self.sounds = {x: g[0] for g in _SOUNDS for x in g[1:]}
        alike = {g[0]: f"[{g}]" for g in _SOUNDS}
        #: what any term may look like: texts without it are read as they are
        self.screen = re.compile("|".join("".join(alike.get(c, re.escape(c)) for c in t) for t in terms) or "(?!)")

    def reading(self, text: str) -> str:
        """The text with sound-alikes inside terms replaced; terms do not overlap, longer ones first."""
        if not self.screen.search(text):
            return text
        out: list[str] = []
        i = 0
        while i < len(text):
            best = ""
            stack = [(self.root, i, True)]
            while stack:
                node, j, may = stack.pop()
                if "" in node and j - i > len(best):
                    best = node[""]
                if j == len(text):
                    continue
                if text[j] in node:
                    stack.append((node[text[j]], j + 1, may))
                other = self.sounds.get(text[j]) if may else None
                if other in node:
                    stack.append((node[other], j + 1, False))
            out.append(best or text[i])
            i += len(best) or 1
        return "".join(out)


_ZH_SURE = re.compile(rf"(?:你们?|他|她|您)(?:这个|这种|这群|就是个?|真是个?|是个|是一群)(?:大)?(?:{_Z_INSULT})")


@lru_cache(maxsize=1)
def sound_trie() -> SoundTrie:
    return SoundTrie(sorted(set(_Z_INSULT.split("|"))))


def _wide_scores(text: str, outside: bool) -> dict[str, float]:
    sc = scorers()["zh"]
    out = sc.score(text, outside=outside)
    read = sound_trie().reading(text)
    if read != text and _ZH_SURE.search(read) and not sc.context.search(read):
        v = THRESHOLD if outside else THRESHOLD - QUOTE_PRICE
        out["abusive"] = max(out.get("abusive", 0.0), v)
    return out


# ------------------------------------------------------------------- sentences


def clean(text: str) -> str:
    """Disguises undone that need no lexicon; lower case."""
    t = unicodedata.normalize("NFKC", _INVISIBLE.sub("", text))
    if not t.isascii() and _OTHER_SCRIPT.search(t):
        t = t.translate(_LOOKALIKE)
    t = t.lower()
    if "." in t or "-" in t or "_" in t:
        t = _DOTTED.sub(lambda m: re.sub(r"[.·•_-]", "", m.group(0)), t)
    return _DRAWN.sub(r"\1", t)


_DIGIT = re.compile(r"\d")
# Pairs of quotation marks, and words of speech.
_QUOTE = re.compile("\"[^\"]{2,}\"|“[^”]{2,}”|«[^»]{2,}»|「[^」]{2,}」|『[^』]{2,}』|‘[^’]{2,}’")
_SPEECH = re.compile(
    r"\b(?:said|says|say|saying|called|calls|calling|wrote|writes|writing|shouted|shouting|yelled|screamed|told|tells|insulted|posted|commented|replied|heard|phrase|remark|comment|graffiti|sign)\b"
    r"|\b(?:nói|bảo|gọi|chửi|mắng|viết|hét|quát|bình luận|trích|kể)\b|[说說称骂喊叫写寫]|评论|留言"
)


def own_words(sentence: str) -> str | None:
    """What of a sentence is the author's own where it quotes another's words; ``None`` where it does not."""
    if not any(map(sentence.__contains__, "\"“«「『‘")):
        return None
    rest = _QUOTE.sub(" ", sentence)
    return rest if rest != sentence and _SPEECH.search(rest) else None


def _tokens(sentence: str) -> list[str]:
    """Words of a sentence, digits that stand for letters read as such.

    Numbers are read as letters only where most of the sentence is written so.
    """
    found = _TOKEN.findall(sentence)
    if not _DIGIT.search(sentence):
        return found
    if all(map(str.isalpha, found)):
        return found
    digits = [not t.isalpha() and _DIGIT.search(t) is not None and t != "18+" for t in found]
    if not any(digits):
        return found
    mixed = sum(d and any(c.isalpha() for c in t) for t, d in zip(found, digits))
    all_ = mixed >= 2 and 2 * sum(digits) >= len(found)
    return [t.translate(_LEET) if d and (all_ or any(c.isalpha() for c in t)) else t for t, d in zip(found, digits)]


def _most(out: dict[str, float], new: dict[str, float]) -> None:
    for c, v in new.items():
        if v > out.get(c, 0.0):
            out[c] = v


def sentence_scores(sentence: str) -> dict[str, float]:
    """Score of one cleaned sentence by category; scores below 0 are left out."""
    own = own_words(sentence)
    out = _scored(sentence, own is None)
    if own is not None:
        _most(out, _scored(own, True))
    if out.get("hateful", 0.0) >= THRESHOLD:
        out.pop("abusive", None)  # the insult is aimed at the group
    return {c: s for c, s in out.items() if s > 0}


def _scored(sentence: str, outside: bool) -> dict[str, float]:
    all_of = scorers()
    out: dict[str, float] = {}
    plain = sentence.isascii()
    wide = not plain and _WIDE.search(sentence)
    rest = sentence
    if wide:
        _most(out, _wide_scores(_NOT_WIDE.sub("", sentence).translate(_SIMPLE), outside))
        rest = _WIDE.sub(" ", sentence)
    tokens = _tokens(rest)
    if not tokens:
        return out
    # words with marks stay so beside unmarked ones: folded they would read as other words
    marked = not plain and _VN_MARK.search(rest)
    spellings = ("vi", "en", "va") if marked else ("en", "va")
    folded = tokens if marked or plain else [fold(t) for t in tokens]
    read = [(name, *all_of[name].readings(folded if name == "va" else tokens)) for name in spellings]
    phrases = [x for name, line, _ in read if "*" in line for x in all_of[name].phrases(line)]
    for name, line, loose in read:
        _most(out, all_of[name].score(line, phrases, alone=name == "vi" or not marked, outside=outside))
        if loose != line and (name != "en" or not marked or all_of["en"].misspelled(tokens)):
            _most(out, all_of[name].score(loose, phrases, alone=False, several=True, outside=outside))
    return out


def text_scores(text: str | None) -> dict[str, float]:
    """Score of a text by category: that of its worst sentence."""
    out: dict[str, float] = {}
    if not text or text.isspace():
        return out
    for s in _SENTENCE.split(clean(text)):
        if s:
            _most(out, sentence_scores(s))
    return out


def score_documents(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``key, source, abusive, hateful, sexual`` for every document; other columns are not read."""
    ship(df.sparkSession)
    narrow = df.select(F.col(key).alias(key), F.col(source).cast("string").alias("source"), F.col(text).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = [text_scores(t.as_py()) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *[pa.array([round(s.get(c, 0.0), 4) for s in scores], pa.float64()) for c in CATEGORIES]],
                names=[key, "source", *CATEGORIES],
            )

    kind = df.schema[key].dataType.simpleString()
    return spread(narrow, key).mapInArrow(run, f"`{key}` {kind}, source string, " + ", ".join(f"{c} double" for c in CATEGORIES))


def flagged(scores: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, category``: one row for each category at the threshold or above."""
    pairs = F.array(*[F.struct(F.lit(c).alias("category"), F.col(c).alias("score")) for c in CATEGORIES])
    return (
        scores.select(key, F.explode(pairs).alias("x"))
        .where(F.col("x.score") >= THRESHOLD)
        .select(key, F.col("x.category").alias("category"))
        .distinct()
    )


def rates(scores: DataFrame) -> DataFrame:
    """Documents and share of flagged ones by clean source name, per category."""
    src = F.lower(F.trim("source"))
    flags = {c: F.sum((F.col(c) >= THRESHOLD).cast("long")) for c in CATEGORIES}
    return scores.groupBy(src.alias("source")).agg(
        F.count("*").alias("n_docs"),
        *[f.alias(f"n_{c}") for c, f in flags.items()],
        *[F.round(f / F.count("*"), 6).alias(f"rate_{c}") for c, f in flags.items()],
    )
