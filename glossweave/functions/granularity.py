"""The granularity of a time expression, by ordered categories of patterns. Built-in expressions only."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_WEEKDAY = "(?:monday|tuesday|wednesday|thursday|friday|saturday|sunday)"
_MONTH = "(?:january|february|march|april|may|june|july|august|september|october|november|december|jan|feb|mar|apr|jun|jul|aug|sep|sept|oct|nov|dec)"
_DAY_OF_MONTH = r"\d{1,2}(?:st|nd|rd|th)?"

# The categories in order of precedence, and the patterns that put a surface into each.
#: Read on the lower-case surface.
LATIN = {
    "Exact": [r"\b\d{1,2}:\d{2}(?::\d{2})?\s*(?:am|pm)?\b", r"\bat\s+\d{1,2}\s*(?:am|pm)\b", r"\b\d{1,2}\s*o'clock\b", r"\bnoon\s+sharp\b", r"\bmidnight\s+sharp\b"],
    "Hour": [r"\b(?:morning|afternoon|evening|night|dawn|dusk)\b", r"\b(?:noon|midnight)\b(?!\s*sharp\b)"],
    "Day": [
        rf"\b{_WEEKDAY}\b",
        r"\b(?:yesterday|today|tomorrow)\b",
        r"\bthe\s+day\s+(?:before|after)\b",
        rf"\b{_DAY_OF_MONTH}\s+(?:of\s+)?{_MONTH}\b",
        rf"\b{_MONTH}\s+{_DAY_OF_MONTH}(?:,\s*\d{{4}})?\b",
        r"\b\d{4}-\d{2}-\d{2}\b",
        r"\b\d{1,2}\s+de\s+\w+\s+de\s+\d{4}\b",
    ],
    "Week": [r"\b(?:last|this|next|past)\s+week\b", r"\bweekend\b", r"\bweeklong\b", r"\bla\s+scorsa\s+settimana\b"],
    "Month": [rf"\b{_MONTH}\b(?!\s+{_DAY_OF_MONTH}\b)", r"\b(?:last|this|next|past)\s+month\b"],
    "Season": [r"\b(?:spring|summer|autumn|fall|winter)\b", r"\bover\s+the\s+holidays\b", r"\bholiday\s+season\b"],
    "Year": [r"^\s*\d{4}\s*$", r"\bin\s+\d{4}\b", r"\b\d+\s+years?\s+ago\b", r"\b(?:last|this|next|past)\s+year\b", r"\bthe\s+\d{4}s\b"],
    "Vague": [
        r"\ba\s+while\b", r"\blong\s+time\b", r"\bages\s+ago\b", r"\brecently\b", r"\blately\b", r"\bonce\b", r"\bback\s+then\b", r"\bin\s+the\s+past\b", r"\blong\s+ago\b",
        r"\bsome\s+time\b", r"\bthe\s+other\s+day\b", r"\bearlier\b", r"\bbefore\b", r"\bformerly\b", r"\bpreviously\b",
    ],
}
#: Read on the surface as it is.
CJK = {
    "Exact": [r"\d{1,2}\s*時\s*\d{1,2}\s*分", r"正午ちょうど", r"\d{1,2}\s*点\s*\d{1,2}\s*分", r"\d{1,2}\s*시\s*\d{1,2}\s*분"],
    "Hour": [r"今朝|今夜|朝|午前|午後|夕方|夜", r"今天早上|那天下午|早上|上午|下午(?!\s*\d{1,2}\s*点\s*\d{1,2}\s*分)|傍晚|晚上", r"아침|오전|오후(?!\s*\d{1,2}\s*시\s*\d{1,2}\s*분)|저녁|밤"],
    "Day": [
        r"月曜|火曜|水曜|木曜|金曜|土曜|日曜", r"一昨日|明後日|昨日|今日|明日", r"\d{1,2}\s*月\s*\d{1,2}\s*[日号號]", r"\d{1,2}[日号號]", r"星期[一二三四五六日天]|周[一二三四五六日天]",
        r"前天|后天|昨天|明天|今天(?!\s*(?:早上|上午|下午|晚上|傍晚))", r"월요일|화요일|수요일|목요일|금요일|토요일|일요일", r"그저께|모레|어제|오늘|내일", r"\d{1,2}\s*월\s*\d{1,2}\s*일",
    ],
    "Week": [r"先週|今週|来週|週末", r"上個星期|這個星期|下個星期|上周|这周|下周|周末|這個週末", r"지난\s*주|이번\s*주|다음\s*주|주말"],
    "Month": [
        r"\d{1,2}\s*月(?!\s*\d{1,2}\s*日)", r"先月|今月|来月", r"\d{1,2}\s*月份?(?!\s*\d{1,2}\s*[日号號])", r"上个月|这个月|下个月", r"\d{1,2}\s*월(?!\s*\d{1,2}\s*일)", r"지난\s*달|이번\s*달|다음\s*달",
    ],
    "Season": [r"春|夏|秋|冬", r"봄|여름|가을|겨울"],
    "Year": [
        r"\d{4}\s*年(?!\s*\d{1,2}\s*月)", r"[\d一二三四五六七八九十百千万两兩]+\s*年前", r"(?:去年|今年|来年|一昨年|再来年)(?!\s*(?:の)?(?:春|夏|秋|冬|[0-9０-９]{1,2}\s*月))",
        r"(?:去年|今年|明年|前年|后年)(?!\s*(?:の)?(?:春|夏|秋|冬|月|周|週|天|日|号|號))", r"\d{4}\s*년(?!\s*\d{1,2}\s*월)", r"\d+\s*년\s*전", r"(?:작년|올해|내년|재작년)(?!\s*(?:봄|여름|가을|겨울|\d{1,2}\s*월))",
    ],
    "Vague": [r"しばらく|ずっと前|最近|以前|昔|かつて|少し前", r"很久以前|前一阵子|不久前|过去|从前|曾经|刚才", r"한참\s*전|오래전|최근|예전|얼마\s*전|옛날"],
}
DEFAULT = "Day"


def phrase(words: str, numbers: bool = False) -> str:
    """The pattern of a vocabulary's phrase as a whole surface; with numbers, {X} and X stand for digits."""
    places = re.split(r"\{X\}|X" if numbers else r"(?!)", words)
    return r"^\s*" + r"\d+".join(r"\s+".join(map(re.escape, p.split(" "))) for p in places) + r"\s*$"


#: The lists of a vocabulary file that belong to each category.
LISTS = {"Day": ["weekdays", "yesterday_today_tomorrow"], "Week": ["week_words"], "Month": ["months", "month_words"], "Season": ["seasons"], "Year": ["year_words"], "Hour": ["time_of_day"], "Vague": ["vague"]}


def load_vocabulary(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The phrases by category of a JSON file that has, for each language, lists of them; what has another form is
    passed over. A small file, read through Spark, so that any of its stores will do."""
    whole = "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
    tables = [t for t in json.loads(whole).values() if isinstance(t, dict)]
    lists = {c: [t.get(name) for t in tables for name in names] for c, names in LISTS.items()}
    return {c: list(dict.fromkeys(x.strip() for own in found if isinstance(own, list) for x in own if isinstance(x, str) and x.strip())) for c, found in lists.items()}


def granularity(surface: Column, vocabulary: dict[str, list[str]] | None = None) -> Column:
    """Struct of granularity, ambiguous and matched_categories.

    Every category is tried; the first one in order names the granularity, two or more are ambiguous.
    None, a blank surface and null are the default without a match. vocabulary adds phrases that
    must be the whole surface, by category.
    """
    surface = F.coalesce(surface, F.lit(""))
    hits = []
    for name in LATIN:
        hit = F.lower(surface).rlike("(?U)" + "|".join(LATIN[name])) | surface.rlike("(?U)" + "|".join(CJK[name]))
        if own := (vocabulary or {}).get(name):
            hit |= surface.rlike("(?iuU)" + "|".join(phrase(p, name == "Year") for p in own))
        hits.append(F.when(hit, name))
    matched = F.array(F.array_compact(F.array(*hits)))  # one element, so that the patterns run once
    graded = F.transform(matched, lambda m: F.struct(F.coalesce(F.get(m, F.lit(0)), F.lit(DEFAULT)).alias("granularity"), (F.size(m) > 1).alias("ambiguous"), m.alias("matched_categories")))
    return F.element_at(graded, 1)
