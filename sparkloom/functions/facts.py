"""Differences of fact between an original and a rewritten text, and leaks of the answer on its surface."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.rules import clean, contains_any, reasons

# Patterns, term lists and markers that decide what counts as a fact or a leak.
NUMERIC_FACT = r"(?<![A-Za-z0-9])[0-9]+(?:\.[0-9]+)?\s*(?:年|月|日|时|小时|分钟|秒|元|万元|公里|千米|米|厘米|毫米|%|％|比例|倍|天|岁|kg|KG|cm|mm|m)"
QUOTED_ENTITY = r"[“\"'《]([^“”\"'《》]{2,24})[”\"'》]"
NEGATIVE_PERMISSION = r"(?:不得|不能|不允许|禁止)([^。；，,;]{1,18})"
PERMISSIONS = ("可以", "允许", "可")
DETERMINISTIC_RESULT_TERMS = ("已经证明", "已经证实", "已查明", "足以认定", "可以认定", "能够认定", "形成闭环", "排他成立", "结论成立")
UNCERTAINTY_TERMS = ("是否", "能否", "不足", "缺少", "不能直接", "尚不能", "仍需", "判断")
NARROWING_TERMS = ("仅限", "只考虑", "限定为", "仅依据", "只依据", "在不考虑")
MATERIAL_LIMIT_TERMS = ("不得补充", "不能补充", "不引入题外", "只能依据", "仅凭现有")
CONCLUSION_WORDING_TERMS = ("是否稳妥", "能否认定", "应如何限定", "支持到什么程度", "能支持到哪一步")
KEY_RESTRICTION_TERMS = ("不得", "不能", "必须", "只能", "仅", "不允许", "禁止")
LEAK_MARKERS = {
    "boundary_language_leak": ("结论边界", "最高支持", "最高能够", "不能直接推出", "仅凭现有材料", "仅凭视频", "不能单独写成", "只能作为线索", "支持到什么程度", "哪些说法不能"),
    "rubric_axis_leak": ("评分维度", "评分标准", "得分点", "本题考查", "判定口径", "预期错误"),
    "reasoning_path_leak": ("先判断", "再判断", "逐项说明", "分别列出", "按以下步骤", "先比较"),
}
CAUTIOUS_OPTIONS = ("疑似", "线索", "初步", "核查", "限定范围", "后续核查")
ASSERTIVE_OPTIONS = ("已查明", "认定", "违法处置", "直接确认", "确定为")
ANSWER_HINTS = ("正确答案", "答案是", "完整证据链", "充分证据清单", "因此可得", "由此可知")
OPTION_LINE = r"(?:^|\s)[A-DＡ-Ｄ甲乙丙丁][.、:：)]"


def numeric_facts(text: Column) -> Column:
    """Distinct numbers with their units, blanks left out."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(f"({NUMERIC_FACT})"), F.lit(1)), lambda x: F.replace(x, F.lit(" "), F.lit(""))))


def quoted_entities(text: Column) -> Column:
    return F.filter(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(QUOTED_ENTITY), F.lit(1)), F.trim)), lambda x: x != "")


def reversed_permissions(old: Column, new: Column) -> Column:
    """What the original forbids and the rewritten text allows: the first twelve characters of each forbidden action."""
    cores = F.transform(F.regexp_extract_all(old, F.lit(NEGATIVE_PERMISSION), F.lit(1)), lambda x: F.substring(F.btrim(x, F.lit(" ：:，,；;。")), 1, 12))
    close = F.regexp_replace(new, r"(可以|允许|可)\s+", "$1")
    allowed = lambda c: F.exists(F.array(*[F.lit(p) for p in PERMISSIONS]), lambda p: F.contains(close, F.concat(p, F.ltrim(c))))
    return F.filter(cores, lambda c: (c != "") & allowed(c))


def fact_check(rows: DataFrame, old: str, new: str, evolved: Column | None = None) -> DataFrame:
    """rows with added_numbers, added_entities, removed_entities, fatal, warnings and passed.

    fatal: numbers with units that the original lacks; entities in quotes that went while others
    came (both are needed); a forbidden action that is now allowed; a certain result where the
    original is uncertain.  warnings: a narrowed scenario, limited material, changed wording of the
    conclusion, dropped restrictions.  Rows that were not rewritten pass.
    """
    df = rows.withColumns({"__old": clean(F.col(old)), "__new": clean(F.col(new))})
    o, n = F.col("__old"), F.col("__new")
    df = df.withColumns({"__on": numeric_facts(o), "__nn": numeric_facts(n), "__oe": quoted_entities(o), "__ne": quoted_entities(n)})
    df = df.withColumns(
        {
            "added_numbers": F.sort_array(F.array_except("__nn", "__on")),
            "added_entities": F.sort_array(F.array_except("__ne", "__oe")),
            "removed_entities": F.sort_array(F.array_except("__oe", "__ne")),
            "__reversed": reversed_permissions(o, n),
        }
    )
    gained = lambda terms: contains_any(n, terms) & ~contains_any(o, terms)
    fatal = reasons(
        [
            (F.size("added_numbers") > 0, "numeric_fact_added_or_conflicted"),
            ((F.size("added_entities") > 0) & (F.size("removed_entities") > 0), "explicit_entity_replaced"),
            (F.size("__reversed") > 0, "text_level_reversal"),
            (gained(DETERMINISTIC_RESULT_TERMS) & contains_any(o, UNCERTAINTY_TERMS), "new_deterministic_evidence_result"),
        ]
    )
    warnings = reasons(
        [
            (gained(NARROWING_TERMS), "scenario_narrowing_warning"),
            (gained(MATERIAL_LIMIT_TERMS), "material_limit_warning"),
            (gained(CONCLUSION_WORDING_TERMS), "conclusion_wording_warning"),
            (contains_any(o, KEY_RESTRICTION_TERMS) & ~contains_any(n, KEY_RESTRICTION_TERMS), "deleted_key_restriction_warning"),
        ]
    )
    if evolved is not None:
        none = F.expr("cast(array() AS array<string>)")
        fatal, warnings = F.when(evolved, fatal).otherwise(none), F.when(evolved, warnings).otherwise(none)
    df = df.withColumns({"fatal": fatal, "warnings": warnings})
    return df.withColumn("passed", F.size("fatal") == 0).drop("__old", "__new", "__on", "__nn", "__oe", "__ne", "__reversed")


def leaks(rows: DataFrame, text: str, markers: Mapping[str, Sequence[str]] = LEAK_MARKERS) -> DataFrame:
    """rows with leak_types, leak_evidence ('type:text'), repeated_sentences, answer_hints and failures.

    A marker of a type is evidence of it.  Options leak when of two or more option lines exactly
    one is cautious and one at least is assertive.  A sentence of twelve characters or more (blanks
    left out) that occurs twice is redundant.
    """
    df = rows.withColumn("__text", clean(F.col(text)))
    t = F.col("__text")
    found = F.filter(F.array(*[F.when(F.contains(t, F.lit(m)), F.struct(F.lit(k).alias("k"), F.lit(m).alias("m"))) for k, ms in markers.items() for m in ms]), lambda x: x.isNotNull())
    options = F.transform(F.filter(F.split(t, r"[\n；;]"), lambda x: x.rlike(OPTION_LINE)), lambda x: clean(x))
    df = df.withColumns({"__marks": found, "__options": options})
    df = df.withColumns({"__cautious": F.filter("__options", lambda x: contains_any(x, CAUTIOUS_OPTIONS)), "__assertive": F.filter("__options", lambda x: contains_any(x, ASSERTIVE_OPTIONS))})
    unsafe = (F.size("__options") >= 2) & (F.size("__cautious") == 1) & (F.size("__assertive") > 0)
    option = F.when(unsafe, F.array(F.struct(F.lit("safe_option_leak").alias("k"), F.get("__cautious", F.lit(0)).alias("m")))).otherwise(F.expr("cast(array() AS array<struct<k: string, m: string>>)"))
    df = df.withColumn("__all", F.concat("__marks", option))
    sentences = F.filter(F.transform(F.split(t, r"[。！？!?；;\n]+"), lambda x: F.regexp_replace(x, r"\s+", "")), lambda x: F.length(x) >= 12)
    df = df.withColumn("__sentences", F.sort_array(sentences))
    twice = F.array_distinct(F.filter("__sentences", lambda x, i: x == F.get("__sentences", i + 1)))
    df = df.withColumns(
        {
            "leak_types": F.array_distinct(F.transform("__all", lambda x: x["k"])),
            "leak_evidence": F.transform("__all", lambda x: F.concat(x["k"], F.lit(":"), x["m"])),
            "repeated_sentences": twice,
            "answer_hints": reasons([(F.contains(t, F.lit(m)), m) for m in ANSWER_HINTS]),
        }
    )
    repeated = F.size("repeated_sentences") > 0
    failures = reasons([(repeated, "semantic_redundancy"), (repeated, "shared_context_repeated"), (F.size("answer_hints") > 0, "answer_hint_expansion"), (F.size("leak_types") > 0, "surface_leak")])
    return df.withColumn("failures", failures).drop("__text", "__marks", "__options", "__cautious", "__assertive", "__all", "__sentences")
