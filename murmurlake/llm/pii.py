"""Personal information inside free text, by weak supervision.

Labelers of three kinds – patterns, gazetteers and context – vote on candidate spans.
Nobody tells which labeler is right: expectation-maximisation over the vote patterns of
all candidates estimates each labeler's reliability and each pattern's probability
(a naive Bayes model of votes with hidden truth, per type), and these soft labels train
the final span classifier: a logistic regression on votes, pairs of votes and what the
span and its surroundings look like. Spans it accepts become typed placeholders; the rest
of the text is untouched.

Candidates are found in one pass over all texts and written as a table. Reliabilities are
estimated on all of them, by counts of vote patterns (at most 3^labelers a type, whatever
the data); the classifier is trained on at most about ``SAMPLE`` candidates a type.
Positions count code points; look-alike digits are mapped one to one, so they hold.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from datetime import date

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmurlake.session import cut

TYPES = ("email", "phone", "id_number", "address", "person")
ACCEPT = 0.5
#: Candidates of a type that the classifier is trained on, chosen by hash, and buckets of its hashed features.
SAMPLE, BUCKETS = 50_000, 256
#: The first labelers read the span itself, the others what stands next to it.
PATTERNS = 3

# Look-alikes of digits and signs, one character for one.
_WIDE = {i + 0xFEE0: chr(i) for i in range(0x21, 0x7F)}
_WIDE |= {0x3000: " "}

# Frequent family names, one and two characters.
_FAMILY1 = (
    "王李张刘陈杨赵黄周吴徐孙胡朱高林何郭马罗梁宋郑谢韩唐冯于董萧程曹袁邓许傅沈曾彭吕苏卢蒋蔡贾丁魏薛叶阎余潘杜戴夏钟汪田任姜范方石姚谭廖邹熊金陆郝孔白崔康毛邱秦江史顾侯邵孟龙万段雷钱汤尹黎易常武乔贺赖龚文"
)
_FAMILY2 = "欧阳 司徒 慕容 上官 司马 诸葛 东方 皇甫 尉迟 公孙 令狐 长孙 宇文 轩辕 夏侯 端木 南宫 独孤".split()
_TITLE = "老师 先生 女士 小姐 同学 师傅 医生 经理 总 主任 阿姨 叔叔 哥 姐".split()
_CITY = "市"
_STREET = "路 街 弄 巷 大道 道 胡同 里".split()
_ROAD_EN = "Street|Road|Avenue|Lane|Drive|Row|Court|Way|Close|Place|Boulevard|Terrace|Square|Hill|St|Rd|Ave|Ln|Dr"

_CN_DIGIT = "零〇一二三四五六七八九"
_H = "一-鿿"
_COUNT = r"(?:\d{1,5}|[一二三四五六七八九十两百]{1,4})"

_EMAIL = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}(?:@|#| ?\((?:at|AT)\) ?| ?\[(?:at|AT)\] ?| at )"
    r"[A-Za-z0-9-]+(?:(?:\.|。| ?(?:\(dot\)|\[dot\]) ?| dot )[A-Za-z0-9-]+)*(?:\.|。| ?(?:\(dot\)|\[dot\]) ?| dot )[A-Za-z]{2,24}(?![A-Za-z])"
)
_PHONE = re.compile(
    r"(?<![\dA-Za-z.+-])(?:\+\d{1,3}[ -]?)?(?:1[3-9]\d{9}|1[3-9]\d[ -]\d{4}[ -]\d{4})(?![\d-])"
    r"|(?<![\dA-Za-z])\+\d{1,3}[ -]?\d{3,5}[ -]?\d{3,8}(?:[ -]?\d{2,4})?(?!\d)"
    r"|(?<!\d)\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\d-])\d{3}-\d{3}-\d{3,4}(?![\d-])|(?<![\dA-Za-z])\d{12}(?!\d)"
    f"|(?<![{_CN_DIGIT}])[一幺][三四五六七八九][{_CN_DIGIT}]{{9}}(?![{_CN_DIGIT}])"
)
_ID = re.compile(r"(?<![\dA-Za-z-])(?:\d{6}[ -]?\d{8}[ -]?\d{3}[\dXx]|\d{3}-\d{2}-\d{4}|[A-Z]{1,2}\d{7,8}|[A-Z]{2}\d{13})(?![\dA-Za-z-])")
_ADDRESS = re.compile(
    f"(?:[{_H}]{{2,8}}?省)?(?:[{_H}]{{2,4}}市)?(?:[{_H}]{{2,4}}?[区县])?[{_H}]{{1,4}}?(?:大道|路|街|巷|弄|胡同)"
    f"(?:{_COUNT}弄)?{_COUNT}号(?:院|楼)?(?:{_COUNT}(?:栋|幢|座|单元|号楼))?(?:{_COUNT}(?:室|单元|房))?(?:\\d{{1,5}}(?:室)?)?"
    f"|(?:[{_H}]{{2,4}}市)?(?:[{_H}]{{2,4}}?[区县])?[{_H}]{{1,4}}?(?:大道|路|街|巷|弄|胡同)口"
    rf"|(?:(?:Flat|Apt|Unit|Suite|Room) \d+[A-Z]?, )?\d{{1,5}}[A-Z]? (?:[A-Z][a-z]+ ){{1,3}}(?:{_ROAD_EN})(?![A-Za-z])(?:, (?:Apt|Flat|Unit|Suite|Room) \d+[A-Z]?)?"
)
# Words that come right before an address and could pass for the start of its first part.
_BEFORE_ADDRESS = "寄到 送到 寄往 搬到 住在 现在住 住 导航搜 搜 送 放到 交到 位于 地址是 地址 在 到 去 是 了 往".split()
_NAME_CONTEXT = re.compile(
    r"(?:我叫|我是|叫|姓名|名叫|联系人|收件人|负责人|主讲|老师|同事|朋友|领导|客户|找|跟|和|给|陪|帮|替|等|问|约|请|见到|碰到|遇到|认识|is|name|for|am|Mr\.|Ms\.|Mrs\.|Dr\.|with|from|by|and|met|call|ask|dear)"
    r"(?:写|是|为)?[:：]?\s*$",
    re.I,
)
# What may follow a name: the end of a run of characters, or verbs, particles and words of time.
_NAME_AFTER = re.compile(f"^(?:[^{_H}]|$|[说问讲答喊请叫托来去走到回打发写做住家是的了吧呢吗啊在把被也都就还又才要会能想让给和跟与同对从将已刚正昨今明前后上下每没不有一两])")
_SPEAKS = re.compile("^(?:[说问讲答喊叫托]|让我|请我)")
_NAME_EN = re.compile(r"(?<![A-Za-z])[A-Z][a-z]{1,15} (?:[A-Z]\. )?[A-Z][a-z]{1,15}(?:-[A-Z][a-z]+)?(?![A-Za-z])")
_NAME_ZH = re.compile(f"(?:{'|'.join(_FAMILY2)}|[{_FAMILY1}])[{_H}]{{1,2}}")
# Any place where a name may start: a text's or word's edge, or a context that names follow.
_START_ZH = re.compile(f"(?<![{_H}])(?=[{_H}])|我叫|我是|联系人|收件人写?|负责人|主讲是?|找|跟|和|给|叫做|名叫|姓名|陪|帮|替|等|问|约|请|同事|朋友|领导|客户")
# English words that begin sentences, greetings and titles of things, and look like names there.
_NOT_NAME_EN = frozenset(
    "Good Happy Dear Best Kind Many Thank Thanks Please Hello Hi The This That These Those What When Where Which Who Why How Yes No Not New Merry Have Has Had Let See Are Is Was Will Can May Morning Evening Night "
    "Monday Tuesday Wednesday Thursday Friday Saturday Sunday January February March April June July August September October November December".split()
)
# Family names that are everyday words too; what they begin is a name only where something says so.
_FAMILY_WORDS = "石姜方高金江万黄毛田段汤马常文武史龙雷钱孔白夏康易乔于何余任程范叶钟林梁"
_INTRODUCES = re.compile(r"(?:叫|我是|姓名|联系人|收件人|负责人|主讲|老师|同事|朋友|领导|客户|见到|碰到|遇到|认识)(?:写|是|为)?[:：]?\s*$|(?:\b(?:is|name|for|am|Mr\.|Ms\.|Mrs\.|Dr\.|with|met|call|ask|dear)) $", re.I)
# Inside a run of characters only full names of three and more count, between words that names stand between.
_INSIDE_ZH = re.compile(f"(?<=[见到了过是的天后前对把被有为向由从比像当选说])(?=(?P<name>(?:{'|'.join(_FAMILY2)}|[{_FAMILY1}])[{_H}]{{2}}))")
# Characters that hardly stand in a given name, and words of everyday use that start with a family name.
_NOT_GIVEN = re.compile("[的了吗呢吧啊呀哦嘛啦么着过们不是在有去来我你他她它这那就都也还很没到说要会能可看吃喝买给跟和找被把让对从几个些点又再先才只太最]")
_NOT_NAME = re.compile(
    "谢谢|马上|周[末一二三四五六日]|高[兴中考铁手级]|方[便法面向案才]|白[天色菜白痴]|于是|常[常见用识]|万一|金[额色钱]|安[全静排]|钱包|石头|夏[天季]|任[何务]|程[序度]|许多|胡说|"
    "江[边湖]|黄[色瓜昏]|何[必时况]|段[子落]|雷雨|汤圆|武[器术]|范围|田[里野]|余[额下]|叶子|钟[头表]|毛[病巾衣]|孔雀|史上|董事|陆续|龙[虾头]|康复|顾[客虑]|张[开望]|李子|王[国者]|曾经|戴[着上]|"
    "罗[列嗦]|贺[卡年]|文[件章字档化具科学本明艺案]|苏[打州]|郑重|严[重格肃]|邹巴|宋体|唐诗|杨[树梅]|林荫|沈阳|乔迁|..[屋店馆册果]$"
)
# Words of context, wherever they stand in the characters before a span.
_GAP = re.compile(r"[:： ]*")
_TITLED = re.compile(f"(?:{'|'.join(_FAMILY2)}|[{_FAMILY1}])(?:{'|'.join(_TITLE[:5])})")
_NEGATIVE = re.compile(
    r"流水|订单|单号|运单|快递单|会议号?|房间号|版本|编号|型号|批次|病历|卡号|航班|车次|价格|tracking|order|invoice|version|meeting|ticket|build|serial|(?<![A-Za-z])(?:no|v)\.?\s*$", re.I
)
_POSITIVE = {
    "email": re.compile(r"邮箱|邮件|信箱|传到|发到|发给|发我|投|抄送|mail|send|write|contact|reach", re.I),
    "phone": re.compile(r"电话|手机|联系|号码|拨|打给|打我|加我|新的是|微信|call|phone|tel|mobile|text me|reach", re.I),
    "id_number": re.compile(r"身份证|证件|认证|护照|实名|填一下|passport|ssn|social security|licen[cs]e|(?<![A-Za-z])id(?![A-Za-z])", re.I),
    "address": re.compile(r"寄|住|地址|导航|搬|送到|送货|位于|收货|ship|address|live|located|deliver|meet", re.I),
}


def plain_digits(text: str) -> str:
    return text.translate(_WIDE)


def _id_valid(s: str) -> bool:
    digits = re.sub(r"[ -]", "", s)
    if len(digits) != 18:
        return False
    try:
        date(int(digits[6:10]), int(digits[10:12]), int(digits[12:14]))
    except ValueError:
        return False
    return True


def _id_checksum(s: str) -> bool:
    digits = re.sub(r"[ -]", "", s)
    if len(digits) != 18:
        return False
    weights = [2 ** (17 - i) % 11 for i in range(17)]
    return "10X98765432"[sum(int(c) * w for c, w in zip(digits[:17], weights, strict=True)) % 11] == digits[17].upper()


def _trim_address(text: str, start: int, end: int) -> int:
    """The start of the first part: verbs before it don't belong to it."""
    if not re.match(f"[{_H}]", text[start]):
        return start
    # The part that the pattern began with, up to its own mark.
    first = re.search("省|市|区|县|大道|路|街|巷|弄|胡同", text[start:end])
    stop = start + (first.start() if first else 0)
    for word in _BEFORE_ADDRESS:
        at = text.rfind(word, max(0, start - 3), stop)
        if at >= 0 and at + len(word) > start and at + len(word) <= stop - (0 if word == "地址是" else 1):
            start = at + len(word)
    return start


class Labelers:
    """Candidates of a text with votes: (type, start, end, votes); a vote is +, - or 0."""

    names = ("shape", "structure", "gazetteer", "before", "after", "negative")

    def __call__(self, raw: str) -> list[tuple[str, int, int, str]]:
        text = plain_digits(raw)
        out: list[tuple[str, int, int, str]] = []
        digits = any(c.isdigit() for c in text)
        if "@" in text or "#" in text or "at)" in text or "at]" in text or " at " in text:
            for m in _EMAIL.finditer(text):
                out.append(self._votes("email", text, m.start(), m.end()))
            for m in re.finditer(r"(?<![\w.])[A-Za-z0-9._-]+@[A-Za-z0-9-]+(?![\w.。-])", text):
                out.append(self._votes("email", text, m.start(), m.end()))
        if digits or re.search(f"[{_CN_DIGIT}]{{9}}", text):
            for m in _PHONE.finditer(text):
                out.append(self._votes("phone", text, m.start(), m.end()))
            if digits:
                for m in _ID.finditer(text):
                    out.append(self._votes("id_number", text, m.start(), m.end()))
        if "号" in text or "口" in text or digits:
            for m in _ADDRESS.finditer(text):
                start = _trim_address(text, m.start(), m.end())
                out.append(self._votes("address", text, start, m.end()))
        out += self._names(text)
        return out

    @staticmethod
    def _end(text: str, start: int, longest: int) -> int:
        """Where a Chinese name that starts here ends: the longest reading that the text goes on from; else 0."""
        family = 2 if text[start : start + 2] in _FAMILY2 else 1
        for end in range(longest, start + family, -1):
            if not _NOT_GIVEN.search(text, start + family, end) and _NAME_AFTER.match(text[end : end + 1]):
                return end
        return 0

    def _names(self, text: str) -> list[tuple[str, int, int, str]]:
        found: dict[tuple[int, int], None] = {}
        for m in _START_ZH.finditer(text):
            at = _GAP.match(text, m.end()).end()
            n = _NAME_ZH.match(text, at)
            end = n and self._end(text, at, n.end())
            if end and not any(a <= at < b for a, b in found):
                found[(at, end)] = None
        for m in _INSIDE_ZH.finditer(text):
            at = m.start()
            double = text[at : at + 2] in _FAMILY2
            end = self._end(text, at, min(at + (4 if double else 3), len(text)))
            if end - at >= 3 and not any(a < end and at < b for a, b in found):
                found[(at, end)] = None
        if "老师" in text or "同学" in text or "先生" in text or "女士" in text:
            for m in _TITLED.finditer(text):
                found[(m.start(), m.end())] = None
        spans = [self._votes("person", text, a, b) for a, b in found]
        if not text.islower():
            for m in _NAME_EN.finditer(text):
                if (m.start(), m.end()) not in found:
                    spans.append(self._votes("person", text, m.start(), m.end()))
        return spans

    def _votes(self, kind: str, text: str, start: int, end: int) -> tuple[str, int, int, str]:
        s, before, after = text[start:end], text[max(0, start - 14) : start], text[end : end + 12]
        v = dict.fromkeys(self.names, "0")
        if kind == "email":
            v["shape"] = "+" if re.search(r"(?:\.|。|dot ?)\)? ?[A-Za-z]{2,}$", s) else "-"
            v["structure"] = "+" if "@" in s else "0"
            v["gazetteer"] = "+" if re.search(r"(?:com|net|org|cn|edu|example|test|invalid)$", s, re.I) else "-"
        elif kind == "phone":
            digits = re.sub(r"\D", "", s)
            v["shape"] = "+" if s[0] in "+(" or re.match(r"1[3-9]", s) and len(digits) == 11 or s[0] in "一幺" else "-"
            v["structure"] = "+" if 10 <= len(digits) <= 13 and len(digits) != 12 or s[0] in "+(一幺" else "-"
            v["gazetteer"] = "+" if re.match(r"\+(?:86|44|1|81|852|49|33)\b|\+(?:86|44|81)|1[3-9]|[一幺][三四五六七八九]|\(\d{3}\)", s) else "-"
        elif kind == "id_number":
            long = len(re.sub(r"[ -]", "", s)) == 18
            v["shape"] = "+" if long or re.fullmatch(r"\d{3}-\d{2}-\d{4}|[A-Z]{1,2}\d{7,8}", s) else "-"
            v["structure"] = ("+" if _id_valid(s) else "-") if long else "0"
            v["gazetteer"] = ("+" if _id_checksum(s) else "-") if long else "0"
        elif kind == "address":
            v["shape"] = "+" if re.search(r"\d|号", s) and not s.endswith("口") else "-"
            v["structure"] = "+" if re.search(f"{_COUNT}(?:号|弄)", s) or re.search(rf"\d+[A-Z]? [A-Z].*(?:{_ROAD_EN})", s) else "-"
            v["gazetteer"] = "+" if re.search(f"市|区|室|栋|单元|号楼|院|(?:{_ROAD_EN})", s) else "0"
        else:
            family = s[:2] in _FAMILY2 or s[0] in _FAMILY1
            titled = any(s.endswith(t) for t in _TITLE)
            english = s[0].isascii()
            road = english and bool(re.search(rf"\b(?:{_ROAD_EN})$", s) or re.match(rf" (?:{_ROAD_EN})(?![A-Za-z])", after) or re.search(r"\d ?\Z", before))
            v["shape"] = "-" if titled or road else "+"
            v["structure"] = "-" if titled or len(s) < 2 or road else "+"
            common = english and not _NOT_NAME_EN.isdisjoint(s.split())
            v["gazetteer"] = "+" if not common and (family or (english and not road)) else "-"
            v["before"] = "+" if _NAME_CONTEXT.search(before) else "0"
            v["after"] = "+" if _SPEAKS.match(after) else ("-" if re.match(f"[{_H}A-Za-z]", after) else "0")
            # Without any context, two characters are a word rather than a name.
            given = s[2 if s[:2] in _FAMILY2 else 1 :]
            alone = v["before"] != "+" and v["after"] != "+" and len(s) < 3
            alone |= s[0] in _FAMILY_WORDS and s[:2] not in _FAMILY2 and v["after"] != "+" and not _INTRODUCES.search(before)
            word = not english and (_NAME_ZH.fullmatch(s) is None or bool(_NOT_GIVEN.search(given) or _NOT_NAME.match(s)) or alone)
            if word:
                v["gazetteer"] = "-"
            v["negative"] = "-" if titled or road or word or common or before.endswith("@") else "0"
            return kind, start, end, "".join(v[n] for n in self.names)
        denied = [m.end() for m in _NEGATIVE.finditer(before[-_NEAR:])]
        named = [m.end() for m in _POSITIVE[kind].finditer(before[-_NEAR:])]
        # The nearer word of context counts.
        v["before"] = "0" if not denied and not named else "+" if max(named, default=-1) > max(denied, default=-1) else "-"
        # A span that runs on into letters or digits of its own kind is part of something else.
        v["after"] = "-" if re.match(r"[A-Za-z0-9_/.]" if kind != "address" else r"[A-Za-z0-9]", after) and not re.match(r"\.(?:\s|$)", after) else "0"
        if denied:
            v["negative"] = "-"
        return kind, start, end, "".join(v[n] for n in self.names)


_NEAR = 10


def surroundings(text: str, kind: str, start: int, end: int) -> list[int]:
    """Hashed features of a span and what is next to it: characters on both sides, length and classes of its own."""
    s = text[start:end]
    shape = re.sub(r"(.)\1+", r"\1", "".join("9" if c.isdigit() else "a" if c.isascii() and c.isalpha() else "字" if c.isalpha() else c for c in s))
    named = (
        f"<{text[max(0, start - 1) : start]}", f"<<{text[max(0, start - 2) : start]}", f">{text[end : end + 1]}", f">>{text[end : end + 2]}",
        f"#{min(len(s), 30)}", f"={shape[:12]}", f"|{start == 0}{end == len(text)}",
    )
    return sorted({zlib.crc32(f"{kind}{n}".encode("utf-8", "surrogatepass")) % BUCKETS for n in named})


def find_candidates(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, spans): the rows with candidates; spans is array<struct<kind, start, stop, votes, near>>.

    Null and empty texts have none. ``key`` may repeat: rows keep to themselves.
    """
    kind = df.schema[key].dataType.simpleString()
    rows = df.where(F.length(text) > 0).select(F.col(key).alias("k"), F.col(text).alias("t"))
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("votes", pa.string()), ("near", pa.list_(pa.int32()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label = Labelers()
        for batch in batches:
            hits, spans = [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                found = label(t)
                if found:
                    hits.append(i)
                    spans.append([{"kind": a, "start": b, "stop": c, "votes": v, "near": surroundings(t, a, b, c)} for a, b, c, v in found])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(hits, pa.int64())), pa.array(spans, pa.list_(span))], names=["k", "spans"])

    return rows.mapInArrow(work, f"k {kind}, spans array<struct<kind string, start int, stop int, votes string, near array<int>>>").withColumnRenamed("k", key)


def _votes_matrix(patterns: list[str]) -> np.ndarray:
    return np.array([[{"+": 1, "-": -1, "0": 0}[c] for c in p] for p in patterns], float)


def reliabilities(patterns: list[str], counts: np.ndarray, steps: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """EM over vote patterns: (posterior of each pattern, P(vote | truth) of each labeler, prior).

    The hidden truth starts at the majority vote, in which the labelers that read the same
    characters – those of the span itself, ``PATTERNS`` – have one vote together; a labeler's three outcomes (+, 0, -)
    have their own probabilities for true and false spans, smoothed alike for all labelers:
    by one count each and one more for what the vote says.
    """
    votes = _votes_matrix(patterns)
    own, others = votes[:, :PATTERNS], votes[:, PATTERNS:]
    post = 1 / (1 + np.exp(-(own.mean(axis=1) + others.sum(axis=1))))
    table = np.zeros((2, votes.shape[1], 3))
    prior = 0.5
    index = votes.astype(int) + 1
    for _ in range(steps):
        prior = float(np.clip((counts * post).sum() / counts.sum(), 1e-3, 1 - 1e-3))
        for truth, w in ((0, counts * (1 - post)), (1, counts * post)):
            for j in range(votes.shape[1]):
                for o, value in enumerate((-1, 0, 1)):
                    table[truth, j, o] = (w * (votes[:, j] == value)).sum() + 1.0 + float(value != 0 and (value > 0) == bool(truth))
                table[truth, j] /= table[truth, j].sum()
        log = [np.log(table[t][np.arange(votes.shape[1]), index]).sum(axis=1) for t in (0, 1)]
        new = 1 / (1 + np.exp(-np.clip(log[1] - log[0] + np.log(prior / (1 - prior)), -50, 50)))
        if np.abs(new - post).max() < 1e-6:
            post = new
            break
        post = new
    return post, table, prior


def _features(patterns: list[str], near: list[list[int]]) -> np.ndarray:
    votes = _votes_matrix(patterns)
    n = votes.shape[1]
    pairs = [votes[:, i] * votes[:, j] for i in range(n) for j in range(i + 1, n)]
    around = np.zeros((len(patterns), BUCKETS))
    for i, of in enumerate(near):
        around[i, list(of)] = 1.0
    return np.column_stack([np.ones(len(votes)), votes, *pairs, around])


def train_classifier(patterns: list[str], near: list[list[int]], counts: np.ndarray, soft: np.ndarray, steps: int = 50) -> np.ndarray:
    """Weights of a logistic regression on votes, pairs of votes and surroundings, from soft labels (Newton steps).

    Spans of one pattern count by the root of their number, so that frequent ones don't drown rare ones.
    """
    x = _features(patterns, near)
    w, c = np.zeros(x.shape[1]), counts**0.5
    ridge = np.full(x.shape[1], 0.05)
    ridge[-BUCKETS:] = 0.5  # surroundings add to what votes say
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (c * (p - soft)) + ridge * w
        hess = (x * (c * p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-5:
            break
    return w


class SpanModel:
    """The trained classifiers of all types; small and sent to the tasks as it is."""

    def __init__(self, weights: dict[str, np.ndarray], tables: dict[str, np.ndarray]):
        self.weights, self.tables = weights, tables
        self.known: dict[tuple[str, str], float] = {}

    def probability(self, kind: str, votes: str, near: list[int]) -> float:
        w = self.weights.get(kind)
        if w is None:
            return 0.0
        own = self.known.get((kind, votes))
        if own is None:
            own = self.known[(kind, votes)] = float((_features([votes], [[]]) @ w)[0])
        first = len(w) - BUCKETS
        return float(1 / (1 + np.exp(-np.clip(own + sum(w[first + i] for i in near), -30, 30))))

    def choose(self, spans: list[tuple[str, int, int, str, list[int]]]) -> list[tuple[str, int, int, float]]:
        """The accepted spans; of overlapping ones the likeliest, then the longest."""
        rated = [(kind, a, b, self.probability(kind, v, near)) for kind, a, b, v, near in spans]
        rated = sorted((r for r in rated if r[3] >= ACCEPT), key=lambda r: (-round(r[3], 1), r[1] - r[2], r[1]))
        kept: list[tuple[str, int, int, float]] = []
        for r in rated:
            if all(r[2] <= k[1] or k[2] <= r[1] for k in kept):
                kept.append(r)
        return sorted(kept, key=lambda r: r[1])


def train(candidates: DataFrame, sample: int = SAMPLE) -> SpanModel:
    """Fit reliabilities on the vote patterns of all candidates and classifiers on at most about ``sample`` of each type."""
    spans = candidates.select(F.explode("spans").alias("s"), F.xxhash64(*candidates.columns).alias("h")).select("s.kind", "s.votes", "s.near", F.xxhash64("h", "s.start").alias("h"))
    counted = spans.groupBy("kind", "votes").agg(F.count(F.lit(1)).alias("n")).orderBy("kind", "votes").collect()  # at most 3^6 rows for each of five types
    soft: dict[tuple[str, str], float] = {}
    weights, tables = {}, {}
    total = {kind: sum(r["n"] for r in counted if r["kind"] == kind) for kind in TYPES}
    for kind in TYPES:
        rows = [r for r in counted if r["kind"] == kind]
        if rows:
            post, tables[kind], _ = reliabilities([r["votes"] for r in rows], np.array([r["n"] for r in rows], float))
            soft |= {(kind, r["votes"]): float(p) for r, p in zip(rows, post, strict=True)}
    chosen = F.coalesce(*[F.when(F.col("kind") == kind, F.pmod("h", F.lit(1_000_000)) < int(1_000_000 * min(1.0, sample / n))) for kind, n in total.items() if n], F.lit(False))
    looks = spans.where(chosen).groupBy("kind", "votes", "near").agg(F.count(F.lit(1)).alias("n")).orderBy("kind", "votes", "near").collect()
    for kind in TYPES:
        rows = [r for r in looks if r["kind"] == kind]
        if rows:
            patterns = [r["votes"] for r in rows]
            labels = np.array([soft[(kind, v)] for v in patterns])
            weights[kind] = train_classifier(patterns, [r["near"] for r in rows], np.array([r["n"] for r in rows], float), labels)
    return SpanModel(weights, tables)


def found_spans(candidates: DataFrame, model: SpanModel, key: str) -> DataFrame:
    """(key, pii_type, start_pos, end_pos, probability) of the accepted spans."""
    kind = candidates.schema[key].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[int, str, int, int, float]] = []
            for i, spans in enumerate(batch.column(1).to_pylist()):
                rows += [(i, *s) for s in model.choose([(s["kind"], s["start"], s["stop"], s["votes"], s["near"]) for s in spans])]
            c = list(zip(*rows, strict=True)) if rows else [[], [], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(c[0], pa.int64())), pa.array(c[1], pa.string()), pa.array(c[2], pa.int32()), pa.array(c[3], pa.int32()), pa.array(c[4], pa.float64())],
                names=["k", "pii_type", "start_pos", "end_pos", "probability"],
            )

    out = candidates.select(F.col(key).alias("k"), "spans").mapInArrow(
        work, f"k {kind}, pii_type string, start_pos int, end_pos int, probability double"
    )
    return out.withColumnRenamed("k", key)


def mask(text: str, spans: list[tuple[str, int, int, float]]) -> str:
    out, at = [], 0
    for kind, a, b, _ in spans:
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def redact(df: DataFrame, model: SpanModel, text: str, masked: str = "masked_text") -> DataFrame:
    """Adds ``masked``: the text with typed placeholders; null stays null."""
    at = df.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label = Labelers()
        for batch in batches:
            out = []
            for t in batch.column(at).to_pylist():
                spans = [(k, a, b, v, surroundings(t, k, a, b)) for k, a, b, v in label(t)] if t else []
                out.append(mask(t, model.choose(spans)) if spans else t)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*batch.schema.names, masked])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(work, f"{schema}, `{masked}` string")


def fit(df: DataFrame, key: str, text: str) -> tuple[DataFrame, SpanModel]:
    """Candidates of all rows, written once, and the model trained on them."""
    candidates = cut(find_candidates(df, key, text), "pii")
    return candidates, train(candidates)

