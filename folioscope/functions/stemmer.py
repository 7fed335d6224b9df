"""The published Snowball algorithm for Russian, and an analyzer with stop words.

Endings are given as the algorithm's description lists them."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Vowels and ending classes of the algorithm.
VOWELS = "аеиоуыэюя"
GERUND_1, GERUND_2 = ("вшись", "вши", "в"), ("ывшись", "ившись", "ывши", "ивши", "ыв", "ив")
ADJECTIVE = ("ими", "ыми", "его", "ого", "ему", "ому", "ее", "ие", "ые", "ое", "ей", "ий", "ый", "ой", "ем", "им", "ым", "ом", "их", "ых", "ую", "юю", "ая", "яя", "ою", "ею")
PARTICIPLE_1, PARTICIPLE_2 = ("ем", "нн", "вш", "ющ", "щ"), ("ивш", "ывш", "ующ")
REFLEXIVE = ("ся", "сь")
VERB_1 = ("ете", "йте", "ешь", "нно", "ла", "на", "ли", "ем", "ло", "но", "ет", "ют", "ны", "ть", "й", "л", "н")
VERB_2 = ("ейте", "уйте", "ила", "ыла", "ена", "ите", "или", "ыли", "ило", "ыло", "ено", "ует", "уют", "ены", "ить", "ыть", "ишь", "ей", "уй", "ил", "ыл", "им", "ым", "ен", "ят", "ит", "ыт", "ую", "ю")
NOUN = ("иями", "ями", "ами", "ией", "иям", "ием", "иях", "ев", "ов", "ие", "ье", "еи", "ии", "ей", "ой", "ий", "ям", "ем", "ам", "ом", "ах", "ях", "ию", "ью", "ия", "ья", "а", "е", "и", "й", "о", "у", "ы", "ь", "ю", "я")
SUPERLATIVE = ("ейше", "ейш")
DERIVATIONAL = ("ость", "ост")
STOPWORDS = (
    "и в во не что он на я с со как а то все она так его но да ты к у же вы за бы по только ее мне было вот от меня еще нет о из ему теперь когда "
    "даже ну вдруг ли если уже или ни быть был него до вас нибудь опять уж вам ведь там потом себя ничего ей может они тут где есть надо ней для мы тебя их "
    "чем была сам чтоб без будто чего раз тоже себе под будет ж тогда кто этот того потому этого какой совсем ним здесь этом один почти мой тем чтобы нее "
    "сейчас были куда зачем всех никогда можно при наконец два об другой хоть после над больше тот через эти нас про всего них какая много разве три эту моя "
    "впрочем хорошо свою этой перед иногда лучше чуть том нельзя такой им более всегда конечно всю между"
).split()
_TOKEN = re.compile(r"[^\W_]+")


def _strip(word: str, start: int, endings: tuple[str, ...], after: str = "") -> str | None:
    """The word without the longest of the endings in word[start:], if there is one."""
    for e in sorted(endings, key=len, reverse=True):
        at = len(word) - len(e)
        if at >= start and word.endswith(e) and (not after or (at > start - 1 and at > 0 and word[at - 1] in after and at - 1 >= start)):
            return word[:at]
    return None


def stem(word: str) -> str:
    word = word.lower().replace("ё", "е")
    m = re.search(f"[{VOWELS}]", word)
    if not m:
        return word
    rv = m.end()
    r1 = _region(word, 0)
    r2 = _region(word, r1)
    step = _first(word, rv)
    if step.endswith("и") and len(step) > rv:
        step = step[:-1]
    done = _strip(step, max(r2, rv), DERIVATIONAL)
    if done is not None:
        step = done
    done = _strip(step, rv, SUPERLATIVE)
    if done is not None:
        step = done
        if step.endswith("нн") and len(step) - 1 > rv:
            step = step[:-1]
    elif step.endswith("нн") and len(step) - 1 > rv:
        step = step[:-1]
    elif step.endswith("ь") and len(step) > rv:
        step = step[:-1]
    return step


def _region(word: str, start: int) -> int:
    m = re.compile(f"[{VOWELS}][^{VOWELS}]").search(word, start)
    return m.end() if m else len(word)


def _either(word: str, rv: int, first: tuple[str, ...], second: tuple[str, ...]) -> str | None:
    a, b = _strip(word, rv, first, "ая"), _strip(word, rv, second)
    if a is None or b is None:
        return b if a is None else a
    return min(a, b, key=len)


def _first(word: str, rv: int) -> str:
    done = _either(word, rv, GERUND_1, GERUND_2)
    if done is not None:
        return done
    word = _strip(word, rv, REFLEXIVE) or word
    done = _strip(word, rv, ADJECTIVE)
    if done is not None:
        return _either(done, rv, PARTICIPLE_1, PARTICIPLE_2) or done
    done = _either(word, rv, VERB_1, VERB_2)
    if done is not None:
        return done
    return _strip(word, rv, NOUN) or word


def analyze(text: str | None) -> list[str]:
    """Stems in order, '' at the place of a stop word, so phrases keep their gaps."""
    return ["" if w in _STOP else stem(w) for w in _TOKEN.findall((text or "").lower())]


_STOP = frozenset(STOPWORDS)


def russian_tokens(text: Column) -> Column:
    """Analyzer for ``retrieval``: same shape as ``simple_tokens``."""
    def analyzed(texts: pd.Series) -> pd.Series:
        known: dict[str, str] = {}  # stems of this batch

        def one(text: str | None) -> list[str]:
            words = _TOKEN.findall((text or "").lower())
            for w in words:
                if w not in known:
                    known[w] = "" if w in _STOP else stem(w)
            return [known[w] for w in words]

        return texts.map(one)

    return F.pandas_udf(analyzed, T.ArrayType(T.StringType()))(text)
