"""Broken prompt and response pairs (problem 4): a conditional random field over response clauses.

A response is cut into clauses; a linear-chain CRF tags each as answer, refusal,
echo, foreign, unfinished or blank (a placeholder). Its weights are fitted on the
driver on at most ``TRAIN_ROWS`` rows of the collection whose responses look
sound, from which defective responses are made by refusing, copying, translating
away, cutting and leaving out. The share of a response that each tag covers then
decides the pair's defect; an echo is also looked up in the prompt.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexgrid.llm.sampling import bounded

TRAIN_ROWS = 1500
ROUNDS = 160  # steps of gradient ascent
ANSWER, REFUSAL, ECHO, FOREIGN, UNFINISHED, BLANK = range(6)
TAGS = 6
TRAIN_CLAUSES = 64  # of a response that the weights are fitted on; tagged are responses of any length
CELLS = 200_000  # clauses and padding decoded at once

_PLACEHOLDER = re.compile(r"^[\s　\-—–―…・.。/_*#()（）\[\]]*(?:n/?a|null|none|nil|tbd|todo|undefined|なし|該当なし|未訳|未翻訳)?[\s　\-—–―…・.。/_*#()（）\[\]]*$", re.I)
_CUT = re.compile(r"(?<=[。！？])(?=[^」』）)”\"])|(?<=[.!?])\s+(?=[^a-z\s])|(?<=[.!?。:：])\s*\n+\s*")
_KANA = re.compile(r"[぀-ヺー-ヿｦ-ﾟ]")
_HAN = re.compile(r"[㐀-鿿]")
_HANGUL = re.compile(r"[가-힣ᄀ-ᇿ]")
_LATIN = re.compile(r"[A-Za-zÀ-ɏ]")
_OTHER = re.compile(r"[Ͱ-׿؀-ۿऀ-෿฀-໿]")
_WORDS = re.compile(r"[^\W_]+")
_SORRY = re.compile(r"申し訳|恐れ入り|すみません|ごめん|残念ながら|あいにく|\b(?:sorry|unfortunately|apologi[sz]e|regret|désolé|leider|je regrette|entschuldigung)\b|抱歉|죄송", re.I)
_CANNOT = re.compile(
    r"(?:でき|出来|いたし|致し|応じ|お受けし|お答えし)ません|できかね|いたしかね|致しかね|しかねます|かねます|差し控え|お断り|控えさせて|対象外|ご用意できません|お役に立てません|\b(?:cannot|can't|can’t|could not|unable to|not able to|must decline|won't|will not be able|refuse to|ne (?:peux|puis) pas|kann (?:ich )?(?:leider )?nicht|not possible for me)\b|无法|不能(?:翻译|回答)|할 수 없",
    re.I,
)
_SELF = re.compile(r"\b(?:I|I'm|I am|as an? (?:automated |ai )?(?:assistant|language model|model))\b|アシスタント|言語モデル|ご依頼|お手伝い|お送りください|お知らせください|ありますか|ご用意|この要求|お答え|ご指定|another form|please (?:supply|provide|send)|さい。?$", re.I)
_POLITE = re.compile(r"(?:です|ます|ません|ました|でした|ください|下さい|でしょうか|ますか)[。？?！]?$")
_CLOSED = re.compile(r"[。．｡.!?！？）)」』】:：;；\]]$")
_GOES_ON = re.compile(r"[;,；、]\s*(?:and|or|及び|または|又は|かつ|並びに)$")
_CLOSING_LEADER = re.compile(r"[.．…]{4,}\s*$")  # a form's blank to fill in
_FINAL = re.compile(r"(?<=[.!?])\s+(?=[A-Z\"“])")


def clauses(answer: str) -> list[str]:
    """The clauses of a response: sentences in any script, without blank ones."""
    return [c for c in (x.strip() for x in _CUT.split(answer)) if c]


def _norm(s: str) -> str:
    return " ".join(_WORDS.findall(s.lower()))


@lru_cache(maxsize=4096)
def _foreign_han(chars: str) -> int:
    n = 0
    for c in chars:
        try:
            c.encode("cp932")
        except UnicodeEncodeError:
            n += 1
    return n


FEATURES = (
    "bias kana0 kana_low kana_high han latin_low latin_half latin_most hangul other nonjis han_no_kana_long sorry cannot self polite echo_part echo_whole echo_words "
    "closed goes_on last first short single prompt_open ellipsis kana_and_cannot latin_and_cannot latin_not_echo last_open last_open_prompt_closed ratio_short placeholder no_letters"
).split()
_AT = {f: i for i, f in enumerate(FEATURES)}


def _features(c: str, k: int, n: int, prompt_norm: str, prompt_words: frozenset, prompt_open: bool, share: float) -> list[int]:
    size = max(len(c), 1)
    kana, han, latin, hangul, other = (len(p.findall(c)) for p in (_KANA, _HAN, _LATIN, _HANGUL, _OTHER))
    letters = max(kana + han + latin + hangul + other, 1)
    on = ["bias"]
    if _PLACEHOLDER.match(c):
        on.append("placeholder")
    if not kana + han + latin + hangul + other:
        on.append("no_letters")
    on.append("kana0" if not kana else "kana_low" if kana < 0.2 * letters else "kana_high")
    if han:
        on.append("han")
    if latin > 0.9 * letters:
        on.append("latin_most")
    elif latin > 0.5 * letters:
        on.append("latin_half")
    elif latin:
        on.append("latin_low")
    if hangul > 0.2 * letters:
        on.append("hangul")
    if other > 0.2 * letters:
        on.append("other")
    if han and not kana:
        if _foreign_han("".join(_HAN.findall(c))):
            on.append("nonjis")
        if han >= 12:
            on.append("han_no_kana_long")
    cannot = bool(_CANNOT.search(c))
    if cannot:
        on.append("cannot")
        on.append("kana_and_cannot" if kana else "latin_and_cannot")
    if _SORRY.search(c):
        on.append("sorry")
    if _SELF.search(c):
        on.append("self")
    if _POLITE.search(c):
        on.append("polite")
    if latin > 0.5 * letters and prompt_norm:
        norm = _norm(c)
        words = norm.split(" ")
        whole = len(norm) >= 8 and norm in prompt_norm
        if whole:
            on.append("echo_whole")
        inside = sum(w in prompt_words for w in words) / len(words)
        if inside > 0.8:
            on.append("echo_words")
        elif inside > 0.5:
            on.append("echo_part")
        if not whole and inside <= 0.8:
            on.append("latin_not_echo")
    closed = bool(_CLOSED.search(c)) and not c.endswith(("…", "..."))
    if closed:
        on.append("closed")
    if c.endswith(("…", "...", "�")) and not prompt_open:
        on.append("ellipsis")
    if _GOES_ON.search(c):
        on.append("goes_on")
    if k == n - 1:
        on.append("last")
        if not closed and not _GOES_ON.search(c):
            on.append("last_open")
            if not prompt_open:
                on.append("last_open_prompt_closed")
    if k == 0:
        on.append("first")
    if size < 12:
        on.append("short")
    if n == 1:
        on.append("single")
    if prompt_open:
        on.append("prompt_open")
    if share < 0.1:
        on.append("ratio_short")
    return [_AT[f] for f in on]


def _is_open(prompt: str) -> bool:
    """The prompt itself ends without a closing mark."""
    return not re.search(r"[.!?:;)\]。：）…]\s*$", prompt) and not _GOES_ON.search(prompt)


def _sequence(prompt: str, answer: str) -> list[list[int]]:
    cs = clauses(answer)
    norm = _norm(prompt) if _LATIN.search(answer) else ""
    words = frozenset(norm.split(" "))
    open_ = _is_open(prompt) or bool(_GOES_ON.search(prompt))
    share = len(answer) / max(len(prompt), 1)
    return [_features(c, k, len(cs), norm, words, open_, share) for k, c in enumerate(cs)]


def _lattice(seqs: list[list[list[int]]], w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Clause scores (sequences, positions, labels) and the mask of positions."""
    longest = max((len(s) for s in seqs), default=1) or 1
    score = np.zeros((len(seqs), longest, TAGS))
    mask = np.zeros((len(seqs), longest), bool)
    flat = [(i, k, f) for i, s in enumerate(seqs) for k, fs in enumerate(s) for f in fs]
    if flat:
        i, k, f = np.asarray(flat).T
        np.add.at(score, (i, k), w[f])
        mask[i, k] = True
    return score, mask


def _fit(seqs: list[list[list[int]]], labels: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the features and of the transitions, by gradient ascent on the penalised conditional likelihood."""
    nf = len(FEATURES)
    w, tr = np.zeros((nf, TAGS)), np.zeros((TAGS, TAGS))
    longest = max(map(len, seqs))
    x = np.zeros((len(seqs), longest, nf))
    y = np.zeros((len(seqs), longest), np.int64)
    mask = np.zeros((len(seqs), longest), bool)
    for i, (s, lab) in enumerate(zip(seqs, labels)):
        for k, fs in enumerate(s):
            x[i, k, fs], y[i, k], mask[i, k] = 1.0, lab[k], True
    gold = np.eye(TAGS)[y] * mask[..., None]
    gold_w = np.einsum("itf,itl->fl", x, gold)
    gold_t = np.einsum("ita,itb->ab", gold[:, :-1], gold[:, 1:])
    mw, vw, mt, vt = np.zeros_like(w), np.zeros_like(w), np.zeros_like(tr), np.zeros_like(tr)
    lse = lambda a, axis: (m := a.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(a - m).sum(axis))
    for step in range(1, ROUNDS + 1):
        e = x @ w
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0]
        for k in range(1, longest):
            new = e[:, k] + lse(alpha[:, k - 1, :, None] + tr, 1)
            alpha[:, k] = np.where(mask[:, k, None], new, alpha[:, k - 1])
        for k in range(longest - 2, -1, -1):
            new = lse(tr + (e[:, k + 1] + beta[:, k + 1])[:, None, :], 2)
            beta[:, k] = np.where(mask[:, k + 1, None], new, 0.0)
        z = lse(alpha[:, -1], 1)
        p = np.exp(alpha + beta - z[:, None, None]) * mask[..., None]
        pair = alpha[:, :-1, :, None] + tr + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None]
        pt = (np.exp(np.minimum(pair, 0)) * mask[:, 1:, None, None]).sum((0, 1))
        gw = (gold_w - np.einsum("itf,itl->fl", x, p)) / len(seqs) - 1e-3 * w
        gt = (gold_t - pt) / len(seqs) - 1e-3 * tr
        for par, g, m, v in ((w, gw, mw, vw), (tr, gt, mt, vt)):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            par += 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w, tr


def _viterbi(seqs: list[list[list[int]]], model: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """The tags of each sequence; sequences of like length are decoded together, a long one alone."""
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(seqs)
    part: list[int] = []
    for i in [*sorted(range(len(seqs)), key=lambda i: len(seqs[i])), None]:
        if part and (i is None or (len(part) + 1) * len(seqs[i]) > CELLS):
            for k, t in zip(part, _decoded([seqs[k] for k in part], model)):
                out[k] = t
            part = []
        if i is not None:
            part.append(i)
    return out


def _decoded(seqs: list[list[list[int]]], model: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    w, tr = model
    score, mask = _lattice(seqs, w)
    n, longest, _ = score.shape
    best, back = score[:, 0].copy(), np.zeros((n, longest, TAGS), np.int64)
    for k in range(1, longest):
        s = best[:, :, None] + tr
        arg = s.argmax(1)
        new = np.take_along_axis(s, arg[:, None, :], 1)[:, 0] + score[:, k]
        back[:, k] = np.where(mask[:, k, None], arg, np.arange(TAGS))
        best = np.where(mask[:, k, None], new, best)
    tags = np.zeros((n, longest), np.int64)
    tags[:, -1] = best.argmax(1)
    for k in range(longest - 1, 0, -1):
        tags[:, k - 1] = np.take_along_axis(back[:, k], tags[:, k : k + 1], 1)[:, 0]
    return [tags[i, : len(s)] for i, s in enumerate(seqs)]


#: Openings and closings from which refusals are made for the fit; foreign sentences likewise.
_REFUSALS = (
    "申し訳ありませんが、この段落の翻訳はお手伝いできません。", "恐れ入りますが、この文は翻訳いたしかねます。別の文章をお送りください。", "この内容については回答を差し控えさせていただきます。",
    "規定により、ご要望にはお答えすることができません。", "すみません、情報が不足しているので訳はご用意できません。", "残念ながら、ご依頼には対応できません。", "ご依頼の文章は対象外のため、訳文を作成できませんでした。",
    "I'm sorry, but I can't help with this text.", "I am unable to provide a translation.", "Sorry, this request cannot be completed. Please supply the text in another form.",
    "As an automated assistant I must decline to process this.", "Unfortunately I cannot answer that. 他にお手伝いできることはありますか。", "Leider kann ich nicht helfen.", "Désolé, je ne peux pas traduire ce passage.",
)
_FOREIGN = (
    "制造商应从批次中提供样品。", "外壳应在规定时间内承受载荷。", "当速度超过限值时，锁定装置应保持有效。", "제조자는 로트에서 시료를 제출하여야 한다.", "속도가 한계를 넘으면 잠금장치는 유지되어야 한다.",
    "Le boîtier doit résister à une charge de 5 N pendant 3 secondes.", "Chaque support est contrôlé tous les 8 mois selon la fiche.", "Der Hersteller stellt 7 Muster zur Verfügung.", "Jede Halterung wird alle 8 Monate geprüft.",
    "El fabricante deberá facilitar las muestras del lote.", "Il costruttore fornisce i campioni del lotto.", "Изготовитель предоставляет образцы из партии.",
    "Here is the version you asked for: it sets 5 mm as the largest gap.", "Summary: item 5 covers a load and a period.", "In short, the limit is low after some runs, nothing else is required.", "This provision asks for samples out of a lot.",
)


_BLANKS = ("N/A", "n/a", "-", "—", "…", "...", "なし", "該当なし", "未訳", "TBD", "null", "none", "。", "(N/A)", "[ ]", "***", "todo", "／")


def _training(rows: list[tuple[str, str]], seed: int = 1) -> tuple[list, list]:
    rng = np.random.default_rng(seed)
    seqs, labels = [], []

    def add(prompt: str, answer: str, tag) -> None:
        s = _sequence(prompt, answer)
        if 0 < len(s) <= TRAIN_CLAUSES:
            seqs.append(s)
            labels.append([tag(k, len(s)) for k in range(len(s))])

    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    for prompt, answer in rows:
        add(prompt, answer, lambda k, n: ANSWER)
        u = rng.random()
        if rng.random() < 0.1:
            add(prompt, pick(_BLANKS), lambda k, n: BLANK)
        if u < 0.2:
            add(prompt, pick(_REFUSALS), lambda k, n: REFUSAL)
        elif u < 0.4:
            ss = _FINAL.split(prompt)
            echo = pick(ss) if rng.random() < 0.5 else prompt
            echo = echo.upper() if rng.random() < 0.2 else echo.replace(",", "") if rng.random() < 0.3 else echo
            add(prompt, echo, lambda k, n: ECHO)
        elif u < 0.65:
            add(prompt, " ".join(pick(_FOREIGN) for _ in range(int(rng.integers(1, 4)))), lambda k, n: FOREIGN)
        elif not _is_open(prompt) and len(answer) > 12:
            cut = answer[: int(rng.integers(4, len(answer) - 2))].rstrip("。.；：、 ")
            if cut and not _CLOSED.search(cut):
                add(prompt, cut + ("…" if rng.random() < 0.1 else ""), lambda k, n: UNFINISHED if k == n - 1 else ANSWER)
    return seqs, labels


def fit(rows: DataFrame, prompt: str = "text", answers: tuple[str, ...] = ("translation", "summary_ja")) -> tuple[np.ndarray, np.ndarray] | None:
    """The CRF, fitted on at most TRAIN_ROWS sound-looking pairs in an order by hash; None where no answer has a clause."""
    both = rows.select(F.col(prompt).alias("p"), F.explode(F.array(*answers)).alias("a")).filter("p is not null and a is not null")
    sound = F.col("a").rlike(r"[぀-ヿ].*(?:。|：|；及び|\))$") & ~F.col("a").rlike(r"[A-Za-z ]{40}|ません|ください")
    # where nothing looks sound, whatever there is
    got = [(r.p, r.a) for r in bounded(both, TRAIN_ROWS, sound) or bounded(both, TRAIN_ROWS)]
    return _fit(*_training(got)) if any(clauses(a) for _, a in got) else None


def _whole_sentence(prompt: str, answer: str) -> bool:
    """The answer repeats the prompt or a whole sentence of it, whatever the case, commas and spacing."""
    a = f" {_norm(answer)} "
    p = _norm(prompt)
    if len(_LATIN.findall(answer)) < 0.3 * len(p.replace(" ", "")) and len(a) < 12:
        return False
    if p and f" {p} " in a:
        return True
    for s in _FINAL.split(prompt):
        n = _norm(s)
        if n.count(" ") >= 3 and f" {n} " in a:
            return True
    return a.count(" ") > 8 and a.strip() in p  # a copy that was itself cut


def defect(prompt: str, answer: str | None, tags: np.ndarray, required: bool) -> str | None:
    """The first defect that fits, from the tags of the answer's clauses."""
    if answer is None:
        return "empty" if required else None
    cs = clauses(answer)
    size = np.asarray([len(c) for c in cs], float)
    cover = np.bincount(tags, size, TAGS) / max(size.sum(), 1.0)
    if not cs or cover[BLANK] > 0.5:
        return "empty"
    latin = len(_LATIN.findall(answer))
    if cover[REFUSAL] >= 0.4:
        return "refusal"
    if cover[ECHO] > 0 and _whole_sentence(prompt, answer):
        return "copied"
    han = _HAN.findall(answer)
    brief = len(han) < 8 and not (latin or _HANGUL.search(answer) or _OTHER.search(answer) or _foreign_han("".join(han)))  # a few characters of either language
    if cover[FOREIGN] + cover[ECHO] >= 0.5 and not brief:
        return "wrong_language"
    if tags[-1] == UNFINISHED and not _is_open(prompt) and not _CLOSING_LEADER.search(answer):
        return "truncated"
    return None


def broken_pairs(rows: DataFrame, key: str = "block_id", prompt: str = "text", answers: tuple[tuple[str, bool], ...] = (("translation", True), ("summary_ja", False)), model=None) -> DataFrame:
    """(key, answer, defect) of each defective answer; ``answers`` names the columns and whether an answer is required.

    Defects, the first that fits: empty, refusal, copied, wrong_language, truncated.
    Rows are independent: no shuffle of texts. Defined results: a null answer is
    empty where required and no pair elsewhere; a null prompt is an empty one;
    rows without key are left out; equal rows count once; an empty table yields
    no row; other columns are ignored; answers of any length are read whole.
    """
    names = [a for a, _ in answers]
    model = model or fit(rows, prompt, tuple(names)) or (np.zeros((len(FEATURES), TAGS)), np.zeros((TAGS, TAGS)))
    shared = rows.sparkSession.sparkContext.broadcast(model)  # a few hundred weights
    need = [r for _, r in answers]

    def tag(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            work = []
            for r in pdf.itertuples(index=False):
                p = r[1] or ""
                for j, name in enumerate(names):
                    a = r[2 + j]
                    if a is None:
                        if need[j]:
                            out.append((r[0], name, "empty"))
                    else:
                        work.append((r[0], name, p, a, need[j]))
            for at in range(0, len(work), 2000):
                part = work[at : at + 2000]
                seqs = [_sequence(p, a) for _, _, p, a, _ in part]
                for (k, name, p, a, required), t in zip(part, _viterbi(seqs, shared.value)):
                    if d := defect(p, a, t, required):
                        out.append((k, name, d))
            yield pd.DataFrame(out, columns=["key", "answer", "defect"])

    kind = rows.schema[key].dataType.simpleString()
    found = rows.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), prompt, *names).mapInPandas(tag, f"key {kind}, answer string, defect string")
    return found.withColumnRenamed("key", key).distinct()
