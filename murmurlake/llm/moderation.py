"""Abusive, hateful or sexual content: a weighted finite-state pattern grammar.

Three transducers are composed, each a weighted finite-state machine:

* ``Spelling`` rewrites disguised spellings (traditional forms, inserted signs and emoji,
  stretched, spaced or leet letters) to plain ones;
* ``Lexicon`` reads the plain text with one automaton and writes weighted tokens: insults,
  dismissals, threats, sexual demands, groups, targets, frames. Pinyin and homophone
  spellings are variants at a cost, so that they only count inside a frame;
* ``Scope`` reads quotes, reporting verbs, titles and negation, and rewrites tokens in
  their scope to mentions, which weigh nothing.

A clause grammar – an automaton over token classes with limited gaps – then scores
matched clauses, never isolated words: the score of a text is its best path's weight.
Whole texts are read; each machine keeps a bounded state, so the cost is linear in their length.

The weights of the token classes are fitted to reviewers' labels (``fit_weights``): a logistic
model of the best path, whose prior are the weights listed here. What it sees of the labelled
rows are counts by path and cost of spelling, so it is fitted to all of them.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, product

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 1.0

# Traditional or variant forms of characters used in the lexicon.
_FORMS = dict(
    zip(
        "廢腦殘癡賤窩囊蟲豬蠢貨賣騷馬脫裸裝傢滾開閉門斷鬆圖癩醜臉爛來還會對師說個這種嗎們掉陪睡覺幫當東",
        "废脑残痴贱窝囊虫猪蠢货卖骚马脱裸装家滚开闭门断松图癞丑脸烂来还会对师说个这种吗们掉陪睡觉帮当东",
        strict=True,
    )
)
_SIGNS = "·•.．・*＊_＿-－—|｜/／~～'`^+=​‌‍﻿⁠️"
_LEET = str.maketrans("013457@$", "oieastas")

# Token class → (weight, words).
WORDS: dict[str, tuple[float, str]] = {
    "insult": (
        0.75,
        "废物 蠢货 白痴 脑残 贱人 窝囊废 垃圾玩意 臭虫 畜生 畜牲 猪脑子 癞蛤蟆 丑八怪 傻逼 傻子 混蛋 人渣 败类 杂种 王八蛋 狗东西 智障 弱智 贱货 蠢猪 "
        "笨蛋 蠢材 蠢蛋 蠢驴 蠢猪 笨猪 饭桶 草包 孬种 懦夫 无赖 恶棍 禽兽 王八 狗娘养的 狗杂种 婊子 荡妇 贱种 烂人 烂货 低能儿 神经病 白眼狼 窝囊货 死肥猪 "
        "idiot moron loser slut bitch bastard scumbag retard whore asshole imbecile cretin dumbass jackass dipshit halfwit dimwit degenerate creep pervert",
    ),
    "mild": (0.35, "垃圾 怪物 玩意 东西 trash stupid pathetic worthless ugly cow pig fool dumb"),
    "you": (0.45, "你这种 你这个 你就是 你个 你们 说你呢 就你 你这人 又是你 你活着 你呼吸 你敢 你怎么 你妈 你爹妈 看到你 烦死你了 把你 生你 你 你是 你真 你才是 你就是个 你不过是 你简直 你他妈 您真是 ur you your youre"),
    "frame": (0.45, "真是个 就是个 全家都是 一家子 全是 都是 照照镜子 嘴这么臭 听不懂人话 刷存在感 就恶心 恶心谁 你这种 你个 说你呢 what a such a you are"),
    "dismiss": (0.5, "滚远点 快滚 赶紧滚 麻溜滚 滚开 滚蛋 给我滚 给我爬 闭嘴 别出来丢人 少说两句会死 活该没人理 也配说话 谁看得起 有脸发消息 没完了是吗 get lost shut up go die jump off drop dead"),
    "demean": (
        0.7,
        "给地球添堵 糟蹋粮食 浪费空气 提鞋都不配 没教过你做人 生块叉烧 笨得跟猪一样 笨得跟驴一样 笨得跟木头一样 看一眼想吐 替你丢人 这身肥肉 就这张脸 长成这样 从楼上跳下去 没人会想你 早点消失 出门就被车撞 也好意思张嘴 活着干嘛 吓谁呢 so is ur family",
    ),
    "attack": (1.0, "人把你埋了 有娘生没娘养 把胎盘养大 去死吧 nobody wants you go kill yourself"),
    "harm": (0.7, "去你家砍人 砍死 弄死你 打断你的腿 把你牙打掉 揍到你跪下 打死你 弄死 砍你 杀了你 kill you beat you up break your legs"),
    "assault": (0.7, "打断他的腿 打断她的腿 打断他们的腿 打死他 打死她 弄死他 弄死她 砍死他 砍死她 杀了他 杀了她 揍死他 揍死她 弄死他们 打死他们 kill him kill her kill them break his legs break her legs"),
    "vow": (0.4, "我要 我会 我非 我一定 我们要 老子 i will ill im going to im gonna we will"),
    "threat": (0.4, "信不信我 堵门口 再让我看见你 你敢再来 等着瞧 i will im going to watch your back"),
    "nude": (0.7, "裸照 没穿衣服的照片 脱光 光着身子 nudes noods clothes off naked pics"),
    "bed": (0.7, "陪我睡 陪睡 跟我睡 陪我上床 上床 来酒店 come to bed sleep with me"),
    "demand": (0.4, "发张 发几张 发我 看看 给我看 给大伙看 跳一段 开视频 今晚来 下班别走 周末来 给你钱 别害羞 别装纯 send show me on cam take your with me now"),
    "lewd": (0.6, "骚 床上肯定更带劲 床上更带劲 想摸"),
    "body": (0.45, "身材 叫得 穿成这样 屁股 胸"),
    "group": (0.4, "人 族 佬 那帮人 那群人 people those 女人 男人 外地人"),
    "dehuman": (
        0.65,
        "能算人吗 活该挨饿 不配上桌 天生就蠢 生下来就低人一等 统统赶出去 都关起来 全清理掉 看着就脏 省得碍眼 骨子里就贱 一股臭味 偷鸡摸狗 见一个赶一个 一个都不该留 懂的都懂 vermin filthy rats subhuman kick them out all of them",
    ),
    "report": (0.0, "骂我 骂人 被骂 有人骂 台词 这种词 这个词 举报 引用 原话 叫我 说我是 骂他 骂她 called me the word quote said"),
    "title": (0.0, "这本 这部 这首 这集 这篇 这个片 小说 电影 歌名"),
    "negation": (0.0, "不是 不算 别说 没说 并非 哪里是 not never isnt arent"),
}

# English words with blanks are one entry: they are listed here again, since WORDS splits at blanks.
_PHRASES = (
    "get lost|shut up|go die|jump off|drop dead|nobody wants you|go kill yourself|so is ur family|kill you|beat you up|break your legs|i will|im going to|"
    "kill him|kill her|kill them|break his legs|break her legs|im gonna|we will|watch your back|clothes off|naked pics|come to bed|sleep with me|show me|on cam|take your|with me now|filthy rats|kick them out|all of them|called me|the word|what a|such a|you are"
).split("|")

# Syllables and sound-alikes of the characters that are disguised this way.
_SYLLABLE = {
    "废": "fei", "物": "wu", "蠢": "chun", "货": "huo", "白": "bai", "痴": "chi", "脑": "nao", "残": "can", "贱": "jian", "人": "ren",
    "窝": "wo", "囊": "nang", "垃": "la", "圾": "ji", "臭": "chou", "虫": "chong", "畜": "chu", "生": "sheng", "猪": "zhu", "子": "zi",
    "滚": "gun", "脱": "tuo", "裸": "luo", "骚": "sao",
}
_SOUND = {
    "废": "费肺", "物": "雾务悟", "蠢": "春", "货": "祸", "痴": "吃", "残": "惨", "贱": "见剑", "人": "仁", "虫": "重冲", "畜": "出处", "生": "牲升",
    "垃": "辣拉", "圾": "鸡机", "脑": "恼", "滚": "棍", "脱": "拖", "裸": "罗", "骚": "搔", "窝": "我", "囊": "馕", "臭": "抽",
}
_SPLIT = {"蠢": "春虫", "贱": "贝戋", "骚": "马蚤", "痴": "疒知", "脑": "月凶", "残": "歹戋"}
_VARIANT_COST = 0.1
_EMOJI = {"🐷": "猪", "🐶": "狗", "💩": "屎"}

_CJK = "㐀-鿿"
_BETWEEN = re.compile(f"(?<=[{_CJK}])\\s+(?=[{_CJK}])")
_STRETCH = re.compile(f"([{_CJK}])\\1+")
_SPACED = re.compile(r"\b(?:[a-z] ){2,}[a-z]\b")
_RUN = re.compile(r"[a-z0-9@$]{2,}")
_MIXED = re.compile(r"[a-z][0134578@$]|[0134578@$][a-z]")
_OPEN, _CLOSE = "“‘「『《\"", "”’」』》\""


class Spelling:
    """Disguised → plain spelling: a character transducer, then three local rewrites."""

    def __init__(self) -> None:
        self.table: dict[int, str | None] = {ord(a): b for a, b in _FORMS.items()}
        self.table |= {i + 0xFEE0: chr(i) for i in range(0x21, 0x7F) if chr(i) not in ",!?;:()"}
        self.table |= {ord(c): None for c in _SIGNS}
        for low, high in ((0x1F000, 0x1FAFF), (0x2600, 0x27BF), (0xFE00, 0xFE0F), (0x1F1E6, 0x1F1FF)):
            self.table |= {c: None for c in range(low, high + 1)}
        self.table |= {ord(a): b for a, b in _EMOJI.items()}

    def __call__(self, text: str) -> str:
        s = text.translate(self.table).lower()
        if not s.isascii():
            s = _STRETCH.sub(r"\1", _BETWEEN.sub("", s))
        if _SPACED.search(s):
            s = _SPACED.sub(lambda m: re.sub(r"(?<!^[ai]) ", "", m[0]), s)  # the first word may be a or i
        return _RUN.sub(self._unleet, s)

    @staticmethod
    def _unleet(run: re.Match[str]) -> str:
        """Signs that stand for letters, from the letters before the first such pair on."""
        r = run[0]
        m = None if r.isalpha() or r.isdigit() else _MIXED.search(r)
        if not m:
            return r
        kept = r[: m.start()].rstrip("abcdefghijklmnopqrstuvwxyz@$")
        return kept + r[len(kept) :].translate(_LEET)


#: (start, end, class, cost of the spelling)
Token = tuple[int, int, str, float]


class Lexicon:
    """Plain text → tokens, by one Aho–Corasick automaton."""

    def __init__(self, words: dict[str, tuple[float, str]] | None = None):
        self.automaton = ahocorasick.Automaton()
        entries: dict[str, dict[str, float]] = {}
        for name, (_, listed) in (words or WORDS).items():
            plain = listed
            phrases = [p for p in _PHRASES if re.search(rf"(?:^| ){re.escape(p)}(?: |$)", listed)]
            for p in phrases:
                plain = re.sub(rf"(?:^| ){re.escape(p)}(?= |$)", " ", plain)
            for word in [*plain.split(), *phrases]:
                for spelled, cost in self.spellings(word):
                    known = entries.setdefault(spelled, {})
                    known[name] = min(known.get(name, 1.0), cost)
        for spelled, classes in entries.items():
            self.automaton.add_word(spelled, (len(spelled), spelled.isascii(), tuple(classes.items())))
        self.automaton.make_automaton()

    @staticmethod
    def spellings(word: str) -> Iterator[tuple[str, float]]:
        collapsed = _STRETCH.sub(r"\1", word)
        yield collapsed, 0.0
        if word.isascii() or len(word) > 5:
            return
        options = []
        for c in word:
            own = [(c, 0.0)]
            own += [(x, _VARIANT_COST) for x in _SOUND.get(c, "")]
            if c in _SYLLABLE:
                own.append((_SYLLABLE[c], _VARIANT_COST / 2))
            if c in _SPLIT:
                own.append((_SPLIT[c], _VARIANT_COST / 2))
            options.append(own)
        for parts in product(*options):
            cost = sum(p[1] for p in parts)
            # One or two disguised characters, or all of them in pinyin: more is another word.
            if 0 < cost <= 2 * _VARIANT_COST + 1e-9:
                yield _STRETCH.sub(r"\1", "".join(p[0] for p in parts)), cost

    def __call__(self, s: str) -> list[Token]:
        found = []
        for end, (length, ascii_word, classes) in self.automaton.iter(s):
            start = end - length + 1
            if ascii_word:
                before, after = s[start - 1 : start], s[end + 1 : end + 2]
                if (before.isascii() and before.isalpha()) or (after.isascii() and after.isalpha()):
                    continue
            for name, cost in classes:
                found.append((start, end + 1, name, cost))
        return found


# What may stand between a denial and the word it denies.
_DENIED_BY = {"", " ", "个", "一个", "什么", "这种", "那种", " a ", " an "}
_LONGEST_DENIAL = max(map(len, _DENIED_BY))
_CLAUSE_END = re.compile(r"[，,。！!？?；;\n]")


class Scope:
    """Rewrites tokens that are quoted, reported, a title or denied to mentions of weight 0."""

    @staticmethod
    def __call__(s: str, tokens: list[Token]) -> list[Token]:
        quoted = sorted(_quoted(s))
        cues: dict[str, list[tuple[int, int]]] = {"report": [], "title": [], "negation": []}
        for a, b, name, *_ in tokens:
            if name in cues:
                cues[name].append((a, b))
        if not quoted and not any(cues.values()):
            return tokens
        opened = [x for x, _ in quoted]
        closed = list(accumulate((y for _, y in quoted), max))  # the furthest end of the quotes opened so far
        said = sorted(y for _, y in cues["report"])
        ends = [m.start() for m in _CLAUSE_END.finditer(s)] if said else []
        titles = sorted(x for x, _ in cues["title"])
        denied = {y for _, y in cues["negation"]}
        out = []
        for token in tokens:
            a, b, name = token[:3]
            if name in cues:
                continue
            i = bisect_right(opened, a)
            hidden = i > 0 and closed[i - 1] >= b
            if not hidden and said:
                # The last verb before the token: what it reports goes to the end of its clause.
                i = bisect_right(said, a)
                hidden = i > 0 and bisect_left(ends, said[i - 1]) == bisect_left(ends, a)
            if not hidden and titles and name in ("insult", "mild", "lewd", "harm"):
                i = bisect_left(titles, b)
                hidden = i < len(titles) and titles[i] - b <= 3
            if not hidden and denied and name in ("insult", "mild", "lewd"):
                hidden = any(y in denied and s[y:a] in _DENIED_BY for y in range(max(0, a - _LONGEST_DENIAL), a + 1))
            if not hidden:
                out.append(token)
        return out


def _quoted(s: str) -> list[tuple[int, int]]:
    spans = []
    for o, c in zip(_OPEN, _CLOSE, strict=True):
        if o not in s:
            continue
        at = 0
        while (a := s.find(o, at)) >= 0 and (b := s.find(c, a + 1)) >= 0:
            spans.append((a, b + 1))
            at = b + 1
    return spans


# The clause grammar: (label, token classes in order, largest gap in characters).
PATHS: tuple[tuple[str, tuple[str, ...], int], ...] = (
    ("insult", ("attack",), 0),
    ("insult", ("you", "insult"), 8),
    ("insult", ("frame", "insult"), 8),
    ("insult", ("insult", "dismiss"), 6),
    ("insult", ("dismiss", "you", "insult"), 6),
    ("insult", ("dismiss", "insult"), 6),
    ("insult", ("insult", "you"), 4),
    ("insult", ("mild", "insult"), 4),
    ("insult", ("mild", "mild", "dismiss"), 4),
    ("insult", ("you", "mild", "frame"), 6),
    ("insult", ("you", "mild", "demean"), 8),
    ("insult", ("demean", "demean"), 8),
    ("insult", ("demean", "mild"), 8),
    ("insult", ("demean", "insult"), 8),
    ("insult", ("you", "demean"), 12),
    ("insult", ("demean", "you"), 4),
    ("insult", ("demean", "dismiss"), 6),
    ("threat", ("threat", "harm"), 10),
    ("threat", ("vow", "harm"), 10),
    ("threat", ("vow", "assault"), 10),
    ("threat", ("threat", "assault"), 10),
    ("threat", ("you", "harm"), 10),
    ("threat", ("harm", "you"), 4),
    ("sexual", ("demand", "nude"), 10),
    ("sexual", ("nude", "demand"), 10),
    ("sexual", ("demand", "bed"), 10),
    ("sexual", ("bed", "demand"), 10),
    ("sexual", ("bed", "bed"), 6),
    ("sexual", ("bed", "insult"), 10),
    ("sexual", ("you", "nude"), 4),
    ("sexual", ("body", "lewd"), 6),
    ("sexual", ("lewd", "lewd"), 4),
    ("hate", ("group", "dehuman"), 10),
    ("hate", ("dehuman", "dehuman"), 6),
    ("hate", ("group", "frame", "insult"), 6),
)


class ClauseGrammar:
    """A weighted automaton over token classes.

    Its state is, of each unfinished path, the best weight for each end that the path's gap
    still reaches: as many as the gap has characters, whatever the text.
    """

    def __init__(self, weights: dict[str, float], paths: tuple[tuple[str, tuple[str, ...], int], ...] = PATHS):
        self.paths, self.weights = paths, weights
        self.steps: dict[str, list[tuple[int, int]]] = {}
        for i, (_, classes, _gap) in enumerate(paths):
            for k, c in enumerate(classes):
                self.steps.setdefault(c, []).append((i, k))

    def __call__(self, tokens: list[Token]) -> tuple[float, int, float]:
        """(weight, path, cost of spelling) of the best path; path is -1 where none is complete."""
        best, path, paid = 0.0, -1, 0.0
        state: dict[tuple[int, int], dict[int, tuple[float, float]]] = {}
        for a, b, name, cost in sorted(tokens):
            own = max(0.0, self.weights[name] - cost)
            for i, k in self.steps.get(name, ()):
                _, classes, gap = self.paths[i]
                score, spent = own, cost
                if k:
                    waiting = state.get((i, k - 1))
                    if not waiting:
                        continue
                    for end in [e for e in waiting if a - e > gap]:
                        del waiting[end]  # tokens come by their start: no later one reaches this end
                    came = max((w for e, w in waiting.items() if e <= a), default=None)
                    if came is None:
                        continue
                    score, spent = came[0] + own, came[1] + cost
                if k == len(classes) - 1:
                    if score > best:
                        best, path, paid = score, i, spent
                else:
                    ends = state.setdefault((i, k), {})
                    ends[b] = max(ends.get(b, (-1.0, 0.0)), (score, spent))
        return best, path, paid


_CORE = {"attack", "insult", "demean", "harm", "assault", "nude", "bed", "lewd", "dehuman", "dismiss", "mild"}


class Grammar:
    """The composed machine: text → (score, label)."""

    def __init__(self, weights: dict[str, float] | None = None) -> None:
        self.spelling, self.lexicon, self.scope = Spelling(), Lexicon(), Scope()
        self.clauses = ClauseGrammar(weights or {name: w for name, (w, _) in WORDS.items()})

    def best_path(self, text: str | None) -> tuple[float, int, float]:
        if not text:
            return 0.0, -1, 0.0
        s = self.spelling(text)
        tokens = self.lexicon(s)
        if not any(t[2] in _CORE for t in tokens):
            return 0.0, -1, 0.0
        return self.clauses(self.scope(s, tokens))

    def __call__(self, text: str | None) -> tuple[float, str]:
        score, path, _ = self.best_path(text)
        return score, PATHS[path][0] if path >= 0 else ""


@lru_cache(maxsize=4)
def grammar(weights: tuple[tuple[str, float], ...] | None = None) -> Grammar:
    return Grammar(dict(weights) if weights else None)


#: How steeply the probability rises around the threshold, and how far weights may well move from their prior.
STEEP, SPREAD = 10.0, 0.05


def label_counts(labelled: DataFrame, text: str = "text", abusive: str = "abusive") -> DataFrame:
    """(path, cost, abusive, n): labelled rows counted by the best path of their texts and its cost of spelling."""
    rows = labelled.where(F.col(abusive).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("t"), (F.col(abusive) != 0).cast("int").alias("y"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = grammar()
        for batch in batches:
            found = [g.best_path(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[1] for x in found], pa.int32()), pa.array([round(x[2], 2) for x in found], pa.float64()), batch.column(1)], names=["path", "cost", "abusive"]
            )

    return rows.mapInArrow(work, "path int, cost double, abusive int").groupBy("path", "cost", "abusive").agg(F.count(F.lit(1)).alias("n"))


def fit_weights(counts: list[tuple[int, float, int, int]], steps: int = 50) -> dict[str, float]:
    """Weights of the token classes, from counts by path, cost and label; without counts the listed ones.

    P(abusive) of a row is the logistic of STEEP × (its best path's weight − threshold);
    weights have a normal prior around the listed ones. Newton steps.
    """
    names = sorted(WORDS)
    prior = np.array([WORDS[n][0] for n in names])
    counts = [c for c in counts if c[0] >= 0]  # a row without a path says nothing about weights
    if not counts:
        return dict(zip(names, prior.tolist(), strict=True))
    x = np.array([[PATHS[p][1].count(n) for n in names] for p, *_ in counts], float)
    cost, y, n = (np.array([c[i] for c in counts], float) for i in (1, 2, 3))
    w = prior.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(STEEP * (x @ w - cost - THRESHOLD), -30, 30)))
        grad = STEEP * x.T @ (n * (p - y)) + (w - prior) / SPREAD**2
        hess = STEEP**2 * (x * (n * p * (1 - p))[:, None]).T @ x + np.eye(len(w)) / SPREAD**2
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -0.1, 0.1)
        if np.abs(step).max() < 1e-6:
            break
    return {k: round(max(0.0, v), 4) for k, v in zip(names, w.tolist(), strict=True)}


def learned_weights(messages: DataFrame, labels: DataFrame, key: str = "row_id", text: str = "text", abusive: str = "abusive", part: int = 2) -> dict[str, float]:
    """Weights fitted to all labelled rows but every ``part``-th by hash of the key, which are left for tests."""
    own = labels.where(F.pmod(F.xxhash64(key), F.lit(part)) != 0).select(key, abusive)
    counts = label_counts(messages.select(key, text).join(own, key), text, abusive)
    return fit_weights([tuple(r) for r in counts.orderBy("path", "cost", "abusive").collect()])  # a row for each path, cost and label


def score_texts(
    df: DataFrame, text: str = "text", score: str = "abuse_score", label: str = "abuse_kind", threshold: float = THRESHOLD, weights: dict[str, float] | None = None
) -> DataFrame:
    """Adds ``score`` (0 and up), ``label`` (insult, threat, sexual, hate or "") and nothing else.

    A null or empty text scores 0. The threshold only sets from where on a label is given.
    ``weights`` are those of ``fit_weights``, or else the listed ones.
    """
    at = df.columns.index(text)
    own = tuple(sorted(weights.items())) if weights else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = grammar(own)
        for batch in batches:
            found = [g(t) for t in batch.column(at).to_pylist()]
            scores = pa.array([round(x[0], 4) for x in found], pa.float64())
            labels = pa.array([x[1] if x[0] >= threshold - 1e-9 else "" for x in found], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores, labels], names=[*batch.schema.names, score, label])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(work, f"{schema}, `{score}` double, `{label}` string")


def rates(scored: DataFrame, by: str, score: str = "abuse_score", threshold: float = THRESHOLD) -> DataFrame:
    """(by, n_rows, n_abusive, rate) of each source; null sources form one group."""
    hit = F.count_if(F.col(score) >= threshold - 1e-9)
    return scored.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_rows"), hit.alias("n_abusive"), F.round(hit / F.count(F.lit(1)), 6).alias("rate")
    )
