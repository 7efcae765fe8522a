"""Rule sets: plain values, loaded from JSON or the defaults below."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields

# Target formats, words of junk titles in the order they are reported, markers of copies and unknown names, order of reports.
TARGET_FORMATS = ("azw", "azw3", "epub", "mobi", "pdf", "txt")
JUNK_KEYWORDS = (
    "夸克网盘", "百度网盘", "更多看这里", "资源分享", "更多整理", "资料 教程 学习 资源汇总", "必看资源库导航", "快速查找资源", "免费资源领取",
    "热门资源领取", "所有资源大汇总", "学习资源领取", "终身学习者的公益资源站", "福利社资源导航", "（防失联必备）", "福利社所有资源", "关注在线更新表格",
    "电子书资源地", "获取更多网盘资源", "热门资源进群获取", "热门资料分享", "资料更新地址", "打开你的网盘浏览", "Thumbs", "更多热门小说领取", "使用手册，必看", "教育考试 学习考证",
)
COPY_MARKERS = ("副本", "Fu Ben")
UNKNOWN_MARKERS = ("Wei Zhi", "Unknown", "Untitled")
REASON_ORDER = {"title_junk_keyword": 1, "duplicate_title_ext_bytes": 2, "non_target_format": 3, "title_mojibake": 4, "title_copy": 5, "file_basename_unknown": 7}
REASON_DETAILS = {"title_mojibake": "title 字段疑似乱码", "title_copy": "title 字段出现副本标记", "file_basename_unknown": "file_basename 未正确识别"}
# The prefix of paths of unknown origin; actions of cleaning, of a merge, those without an operation; policies for conflicts.
UNKNOWN_PREFIX = "未知/"
CLEAN_ACTIONS = ("delete_file", "quarantine_file", "update_metadata", "keep")
NOOP_ACTIONS = ("keep_target", "report_only")
POLICIES = ("fill-missing", "keep-target", "overwrite", "report-only")


@dataclass(frozen=True)
class Layout:
    """Where a batch keeps what its steps write: root/batch/step-N/name."""

    root: str
    batch: str

    def step(self, n: int) -> str:
        return f"{self.root.rstrip('/')}/{self.batch}/step-{n}"

    def path(self, n: int, name: str) -> str:
        return f"{self.step(n)}/{name}"

    def shown(self, path: str) -> str:
        """A path as people read it: below the root without it."""
        return path.removeprefix(self.root.rstrip("/") + "/")


def load_targets(path: str) -> tuple[tuple[str, str], ...]:
    """Scanned columns from a JSON list of objects with table and column."""
    with open(path, encoding="utf-8") as f:
        return tuple((t["table"], t["column"]) for t in json.load(f))


def load_actions(path: str) -> dict[str, tuple[str, ...]]:
    """Valid actions by kind from a JSON object of lists; those named noop are without an operation, whatever the kind."""
    with open(path, encoding="utf-8") as f:
        return {k: tuple(v) for k, v in json.load(f).items()}


@dataclass(frozen=True)
class RuleSet:
    """What the cleaning steps look for; every field can be replaced."""

    target_formats: tuple[str, ...] = TARGET_FORMATS
    junk_keywords: tuple[str, ...] = JUNK_KEYWORDS
    copy_markers: tuple[str, ...] = COPY_MARKERS
    unknown_markers: tuple[str, ...] = UNKNOWN_MARKERS

    @classmethod
    def load(cls, path: str) -> RuleSet:
        """Rules from a JSON object; absent keys keep their defaults, unknown ones are ignored."""
        with open(path, encoding="utf-8") as f:
            given = json.load(f)
        return cls(**{x.name: tuple(given[x.name]) for x in fields(cls) if x.name in given})
