"""Scored rules of the older label set: a score, its label, and evidence flags for each of two texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.functions.rules import Rule, classify, flags, label
from docloom.functions.text import normalise_line

# Scores, patterns, tags, labels and spelling variants of the older label set.
VARIANTS = {"上まわる": "上回る", "上廻る": "上回る"}
PREGNANCY_SCORES = [
    (3, r"(禁忌|投与してはならない|使用してはならない|投与しないこと(?!が望ましい)|使用しないこと(?!が望ましい))", "contraindicated"),
    (2, r"(投与しないことが望ましい|使用しないことが望ましい|原則.*(投与|使用)しない|(投与|使用)は推奨されない|(投与|使用)を避けることが望ましい|(使用|投与)を回避することが望ましい|可能な限り(投与|使用)を避ける)", "not_recommended"),
    (1, r"((治療上の)?(有益性|ベネフィット|利益|利点).*(危険性|リスク).*(上回|凌駕)[るれ]|必要(な|時)?場合に(限り|のみ).*(投与|使用)|やむを得ない場合(に限り|のみ).*(投与|使用)|必要最小限(の用量|の範囲)?(での)?(投与|使用)|慎重に投与)", "benefit_over_risk_or_caution"),
]
LACTATION_SCORES = [
    (3, r"(授乳.*中止|断乳|母乳栄養.*中止)", "stop_lactation"),
    (2, r"(有益性.*考慮.*授乳.*(継続|中止).*検討)", "consider_benefit"),
    (1, r"(乳汁|母乳).*(移行|検出|認められた)", "info_only"),
]
PREGNANCY_FLAGS = {
    "has_human_terato": r"(ヒト|人).*(奇形|催奇形|胎児障害|胎児毒性|胎児への影響|出生児.*(障害|影響))",
    "has_animal_terato": r"(動物|非臨床|ラット|マウス|ウサギ|サル).*(催奇形|奇形性|胎児毒性|胚.*致死|胎仔.*死亡|胎児.*影響)",
    "has_nonmalform_harm": r"(新生児|出生児).*(呼吸抑制|低血糖|離脱|禁断|鎮静|筋(緊張|弛緩)|神経|発達遅延|出血|動脈管.*(収縮|閉鎖)|骨.*(発育|成長|石灰化))",
    "mentions_trimester": r"妊娠(初期|中期|後期|末期)|第[一二三1-3]三?半期|[1-3]期|妊娠[0-9０-９]{1,2}\s*ヶ?月",
    "mentions_uncertain": r"(影響が不明|データが(ない|不足)|情報が不足|未知)",
    "pharm_concern": r"(薬理作用|プロスタグランジン|RAAS|アンジオテンシン|NSAID|抗てんかん|葉酸拮抗|レチノイド|スタチン)",
}
LACTATION_FLAGS = {
    "milk_transfer_detected": r"(乳汁|母乳).*(移行|検出|認められた|検出された)",
    "milk_transfer_not_detected": r"(乳汁|母乳).*(移行しない|検出されなかった|認められない)",
    "adverse_infant_effects": r"(乳児|新生児|出生児).*(傾眠|鎮静|下痢|発疹|嘔吐|体重増加不良|呼吸抑制|肝障害|黄疸)",
    "recommend_stop_lactation": r"(授乳.*中止|断乳|母乳栄養.*中止)",
    "recommend_consideration": r"(有益性.*考慮.*(継続|中止).*検討)",
    "pumping_discard": r"(搾乳.*破棄|ミルク.*置換|代替栄養|人工乳)",
}
PREGNANCY_LABELS = {3: "D/X", 2: "C", 1: "B", 0: "不明"}
LACTATION_LABELS = {3: "授乳中止", 2: "有益性考慮", 1: "情報提供", 0: "不明"}
# End of fixed values.


def scored(text: Column, table: list[tuple[int, str, str]]) -> Column:
    """A struct of score and rule: the first rule that the one-line text matches; 0 for none, and for a blank text."""
    rules = [Rule(f"(?s){p}", {"score": s, "rule": tag}) for s, p, tag in table]
    blank = F.struct(F.lit(0).alias("score"), F.lit("none").alias("rule"))

    def told(line: Column) -> Column:
        return F.when(F.coalesce(line, F.lit("")) == "", blank).otherwise(classify(line, rules, {"score": 0, "rule": "unclear"}))

    # The line is the argument of a lambda so that it is made once, not for each rule.
    return F.get(F.transform(F.array(normalise_line(text, VARIANTS)), told), F.lit(0))


def evidence_flags(text: Column, patterns: dict[str, str]) -> Column:
    """A map of flags of the raw text; empty for a blank one."""
    return flags(text, {k: f"(?ms){p}" for k, p in patterns.items()})


def score_label(score: Column, names: dict[int, str]) -> Column:
    return label(score, names, names[0])
