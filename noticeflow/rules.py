"""Rule tables as data. Operators take rules as arguments; these are the domain's own."""

from __future__ import annotations

from dataclasses import dataclass

#: Flags that give Java's patterns the meaning they have elsewhere: Unicode classes and case, and \n alone as line end.
FLAGS = "(?iuUd)"


#: A word boundary by letters, digits and underscore of any script, whatever the Java version takes for \b.
BOUNDARY = r"(?:(?<=[\p{L}\p{N}_])(?![\p{L}\p{N}_])|(?<![\p{L}\p{N}_])(?=[\p{L}\p{N}_]))"


def java(pattern: str) -> str:
    """A pattern as Java is to read it."""
    return FLAGS + pattern.replace(r"\b", BOUNDARY)


def literal(word: str) -> str:
    """A word as a pattern that matches it alone."""
    return "".join("\\" + c if not c.isalnum() and c.isascii() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """A named pattern; of an exclusion the pattern is the name. A text that matches has one of the hints, case aside.

    A plain pattern is nothing but words, which are its hints then.
    """

    name: str
    pattern: str
    words: tuple[str, ...] = ()

    @property
    def plain(self) -> bool:
        return not set(self.pattern) & set(r"\.^$*+?{}[]()")

    @property
    def hints(self) -> tuple[str, ...]:
        return tuple(self.pattern.split("|")) if self.plain else self.words


# Enumerations, field orders, word lists and patterns of the data model.
MODES = ("daily-push", "search-only", "verify-only", "report-only", "update-only")
DECISIONS = ("create", "update", "exclude", "manual")
CATEGORIES = ("仪器", "试剂", "其他")
MATCH_LEVELS = ("full", "partial", "unknown")
CREATE_STATUSES = ("active", "intel", "manual")
UPDATE_STATUSES = ("active", "intel", "manual", "closed", "canceled")
CHANGE_TYPES = ("status_change", "deadline_change", "correction")
MATCHED_CATEGORIES = (
    "过敏原sIgE试剂", "总IgE试剂", "自身抗体/自身免疫试剂", "酶联免疫(ELISA)试剂", "化学发光免疫试剂", "免疫荧光/免疫印迹试剂", "免疫质控品/校准品",
    "化学发光免疫分析仪", "全自动酶免工作站/酶免仪", "酶标仪", "洗板机", "其他免疫分析仪器", "配套耗材", "其他",
)
CATEGORY_OF = dict.fromkeys(MATCHED_CATEGORIES[:7], "试剂") | dict.fromkeys(MATCHED_CATEGORIES[7:12], "仪器") | dict.fromkeys(MATCHED_CATEGORIES[12:], "其他")
CREATE_FIELDS = (
    "title", "record_id", "region", "project_code", "purchaser", "agency", "procurement_method", "notice_type", "category", "budget",
    "tech_key_points", "publish_date", "doc_fetch_end", "deadline", "days_left", "contact", "source_url", "attachment", "match_level",
    "matched_category", "status", "requires_manual", "designated_supplier", "winner", "award_amount", "notes",
)
UPDATE_FIELDS = (
    "record_id", "change_type", "status", "notice_type", "publish_date", "deadline", "winner", "award_amount", "designated_supplier", "budget",
    "contact", "attachment", "source_url", "notes",
)
NUMBER_FIELDS = ("budget", "days_left", "award_amount")
BOOL_FIELDS = ("requires_manual",)
REGION_PROVINCES = {
    "北京直管区": ("北京",),
    "华北一区": ("河北", "天津", "山东"),
    "华北二区": ("河南", "山西"),
    "西北大区": ("陕西", "甘肃", "青海", "宁夏", "西藏"),
    "东北一区": ("辽宁", "吉林"),
    "东北二区": ("内蒙古", "黑龙江", "新疆"),
    "华东大区": ("浙江", "上海", "江苏"),
    "华南大区": ("广东", "广西", "海南"),
    "华中大区": ("湖北", "安徽", "湖南"),
    "东南大区": ("福建", "江西"),
    "西南大区": ("四川", "重庆", "云南", "贵州"),
}
NO_REGION = "未知或非传统大区"
MASKED_PURCHASER = "未披露（第三方脱敏）"
NO_AUTHORITY = "未知"
TRACKING_KEYS = ("spm", "from", "source", "track", "timestamp", "t")
TRACKING_PREFIX = "utm_"
UPDATE_WORDS = ("中标", "成交", "废标", "流标", "更正", "变更", "合同公告", "终止", "撤销")
INTENT_WORDS = (
    "招标", "采购", "询价", "磋商", "谈判", "比选", "遴选", "竞价", "议价", "单一来源", "中标", "成交", "合同", "采购意向", "需求调查", "市场调研",
    "参数征集", "供应商征集", "征集公告", "结果公示", "候选人公示", "废标", "流标", "更正", "变更", "终止", "撤销",
)
QUERY_ENDINGS = ("招标公告", "采购公告", "询价公告", "磋商公告", "谈判公告", "采购意向", "招标", "采购")
QUERY_CHARS = 100
FATAL_CODES = (10401, 10403, 10406, 10409, 10410, 10412)
RETRY_CODES = (10500, 700429)
TIME_RANGES = ("OneDay", "OneWeek", "OneMonth", "OneYear")
EXCLUSIONS = tuple(
    Rule(p, p, ("食堂",))
    for p in (
        "食堂.*食材|食材.*食堂", "职工体检|员工体检", "餐饮服务", "外送检测服务|检验外送服务", "物业服务", "保洁服务",
        "科普|健康教育|患者教育|研究进展|学术论文|文献解读", "产品介绍|新品发布|促销活动|营销方案|品牌推广",
        "行业报告|市场分析|操作指南|使用说明|招聘公告", "会议通知|培训通知|展会通知",
    )
)
SIGNALS = (
    Rule("过敏原sIgE试剂", r"过敏原|过敏源|变应原|特异性\s*IgE|sIgE", ("过敏原", "过敏源", "变应原", "特异性", "sIgE")),
    Rule("总IgE试剂", r"总\s*IgE|tIgE", ("总", "tIgE")),
    Rule("自身抗体/自身免疫试剂", r"自身抗体|自身免疫|抗核抗体|\bANA\b|\bENA\b|双链\s*DNA|dsDNA|\bANCA\b", ("自身抗体", "自身免疫", "抗核抗体", "ANA", "ENA", "双链", "dsDNA", "ANCA")),
    Rule("酶联免疫(ELISA)试剂", r"酶联免疫|\bELISA\b", ("酶联免疫", "ELISA")),
    Rule("化学发光免疫", r"化学发光.{0,8}(?:免疫|分析仪|试剂|检测)|(?:免疫|分析仪|试剂|检测).{0,8}化学发光|发光免疫", ("化学发光", "发光免疫")),
    Rule("免疫荧光/免疫印迹", r"免疫荧光|免疫印迹|免疫印迹仪"),
    Rule("免疫质控品/校准品", r"免疫.{0,8}(?:质控品|校准品)|(?:质控品|校准品).{0,8}免疫", ("质控品", "校准品")),
    Rule("免疫分析仪器", r"化学发光免疫分析仪|免疫分析仪|全自动酶免|酶免工作站|酶免仪|酶标仪|洗板机"),
)
SIGNAL_CATEGORIES = {
    "过敏原sIgE试剂": ("过敏原sIgE试剂",),
    "总IgE试剂": ("总IgE试剂",),
    "自身抗体/自身免疫试剂": ("自身抗体/自身免疫试剂",),
    "酶联免疫(ELISA)试剂": ("酶联免疫(ELISA)试剂",),
    "化学发光免疫": ("化学发光免疫试剂", "化学发光免疫分析仪"),
    "免疫荧光/免疫印迹": ("免疫荧光/免疫印迹试剂",),
    "免疫质控品/校准品": ("免疫质控品/校准品",),
    "免疫分析仪器": ("化学发光免疫分析仪", "全自动酶免工作站/酶免仪", "酶标仪", "洗板机", "其他免疫分析仪器"),
}
PRESCREEN_WORDS = ("服务", "送检", "食堂", "员工体检", "职工体检", "外送", "配送")
METHOD_WORDS = (
    "30T/盒", "微流控化学发光法", "量子点免疫", "流式荧光", "干式荧光", "磁条码免疫荧光", "综合22项", "斑点酶", "荧光免疫法", "间接免疫荧光法（IIF）",
    "蛋白芯片法", "时间分辨荧光免疫层析法", "免疫组化", "生物芯片", "免疫比浊法", "流式细胞仪", "免疫印迹",
)
#: Names under which anything may be bought.
GENERIC_WORDS = ("试剂一批", "生物试剂盒")
UNVERIFIED_WORDS = ("无法访问", "访问失败", "打不开", "未核实", "反爬", "登录墙")
BY_HAND = "人工"
INTEL_NOTICES = ("单一来源", "中标", "成交", "合同", "意向")
ATTACHMENT_TYPES = ("pdf", "doc", "docx", "xls", "xlsx", "zip", "rar", "7z")
#: Which of several attachments is the main one: the first whose name holds one of these.
ATTACHMENT_ORDER = ("招标文件", "采购文件", "需求")


def any_of(words: tuple[str, ...]) -> str:
    return "|".join(words)


#: What each mode may send.
PUSHES = {"daily-push": ("create", "update"), "update-only": ("update",)}
