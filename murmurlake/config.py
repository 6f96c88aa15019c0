"""Thresholds of the block pipeline as immutable settings.

Two presets carry the two published threshold sets; a TOML file in the public layout
(sections ``time``, ``interruption``, …) may overlay either. Unknown keys are ignored,
wrong kinds and impossible values raise ``ValueError`` with every finding.
"""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, field, fields, replace
from pathlib import Path
from typing import Any

BUCKETS = ("candidates", "micro_style", "need_anonymize", "chaos_style", "debatable", "rejected")
MINED_BUCKETS = ("candidates", "micro_style", "need_anonymize", "chaos_style", "rejected")


@dataclass(frozen=True)
class Settings:
    """One flat set of thresholds; the default values are the code preset."""

    session_gap_minutes: float = 20
    turn_gap_seconds: float = 90
    my_block_continue_seconds: float = 180
    light_interruption_chars: int = 30
    hard_interruption_chars: int = 100
    max_light_interruptions: int = 5
    min_my_block_chars: int = 50
    good_my_block_chars: int = 120
    min_my_char_ratio: float = 0.50
    min_my_msg_count: int = 2
    short_fragment_chars: int = 3
    max_block_chars: int = 1200
    max_fragment_count: int = 120
    candidate_min_style_score: float = 5
    candidate_min_chars_when_style_high: int = 30
    micro_style_min_style_score: float = 2
    need_anonymize_min_style_score: float = 3
    junk_reject_score: float = 6
    chaos_separate_score: float = 4
    debatable_min_style_score: float = 4
    debatable_max_per_run: int = 200
    privacy_medium_threshold: float = 5
    max_short_fragment_ratio: float = 0.70
    max_chaos_ratio_for_candidate: float = 0.30
    max_other_char_ratio_inside_my_block: float = 0.45
    duplicate_keep_limit: int = 3
    near_duplicate_enable: bool = False
    near_duplicate_threshold: float = 0.85
    debatable_enable: bool = True
    style_tags_enable: bool = True
    privacy_mode: str = "balanced"
    drop_sentence_words: tuple[str, ...] = ()
    mask_words: tuple[str, ...] = ()
    private_names: tuple[str, ...] = ()
    private_places: tuple[str, ...] = ()
    me_ids: tuple[str, ...] = ()
    me_names: tuple[str, ...] = ()
    mining_enabled: bool = True
    min_n: int = 2
    max_n: int = 4
    min_freq: int = 5
    min_pmi_2gram: float = 2.0
    min_pmi_3gram: float = 3.0
    min_pmi_4gram: float = 4.0
    min_entropy: float = 0.5
    top_k_each_length: int = 500
    keyness_enabled: bool = True
    compare_against_rejected: bool = True
    min_keyness: float = 1.5
    bucket_weight: tuple[tuple[str, float], ...] = (
        ("candidates", 1.0),
        ("micro_style", 1.2),
        ("chaos_style", 0.5),
        ("need_anonymize", 0.4),
        ("rejected", -0.5),
    )
    clustering_enabled: bool = True
    min_surface_overlap: float = 0.5
    auto_promote_enabled: bool = True
    promote_min_style_keyness: float = 3.0
    promote_min_pmi: float = 3.0
    promote_min_entropy: float = 1.0
    promote_min_freq: int = 10
    promote_max_chaos_rate: float = 0.15
    promote_max_privacy_rate: float = 0.15
    promote_max_per_run: int = 30
    human_review_sample_size: int = 100
    sample_seed: int = 20260710
    keep_rejected: bool = True
    candidate_ratio_target_min: float = 0.05
    candidate_ratio_target_max: float = 0.12
    chaos_style_ratio_max: float = 0.10
    writer_name: str = ""
    scan_sources: tuple[str, ...] = ("my_text",)
    update_candidates: bool = False
    update_phrase_bank: bool = False
    mask_nested: bool = False

    def weight(self, bucket: str) -> float:
        return dict(self.bucket_weight).get(bucket, 0.0)

    def with_(self, **changes: Any) -> Settings:
        return check(replace(self, **changes))


CODE_DEFAULTS = Settings()
TUNED = replace(
    CODE_DEFAULTS,
    my_block_continue_seconds=120,
    light_interruption_chars=20,
    hard_interruption_chars=90,
    max_light_interruptions=4,
    min_my_block_chars=20,
    good_my_block_chars=100,
    min_my_char_ratio=0.60,
    min_my_msg_count=1,
    max_block_chars=1000,
    max_fragment_count=90,
    candidate_min_chars_when_style_high=45,
    junk_reject_score=5,
    chaos_separate_score=2,
    max_short_fragment_ratio=0.60,
    max_chaos_ratio_for_candidate=0.20,
    max_other_char_ratio_inside_my_block=0.30,
    duplicate_keep_limit=2,
    auto_promote_enabled=False,
)

#: Section of the TOML layout and key there → field here, where the names differ or the section matters.
_RENAMED = {
    ("privacy", "mode"): "privacy_mode",
    ("debatable", "enable"): "debatable_enable",
    ("style_tags", "enable"): "style_tags_enable",
    ("phrase_mining", "enabled"): "mining_enabled",
    ("phrase_mining.keyness", "enabled"): "keyness_enabled",
    ("phrase_mining.keyness", "compare_candidates_against_rejected"): "compare_against_rejected",
    ("phrase_mining.clustering", "enabled"): "clustering_enabled",
    ("phrase_mining.auto_promote", "enabled"): "auto_promote_enabled",
    ("debatable", "max_per_run"): "debatable_max_per_run",
    ("phrase_mining.output", "update_auto_phrase_candidates"): "update_candidates",
    ("phrase_mining.output", "update_phrase_bank"): "update_phrase_bank",
    ("phrase_mining.bucket_weight", "*"): "bucket_weight",
} | {
    ("phrase_mining.auto_promote", k): f"promote_{k}"
    for k in ("min_style_keyness", "min_pmi", "min_entropy", "min_freq", "max_chaos_rate", "max_privacy_rate", "max_per_run")
}
# What a settings file may hold besides thresholds: paths and word lists, read by the commands, and switches of output files.
_ELSEWHERE = ("meta", "path", "message", "lexicon", "output", "style_markers", "light_interruption", "chaos")
_BESIDES = {("review", "decisions_path"), ("tuning_advice", "enable"), ("style_tags", "argument_markers"), ("style_tags", "analysis_markers"), ("phrase_mining.output", "*")}
_POSITIVE = ("session_gap_minutes", "turn_gap_seconds", "my_block_continue_seconds", "short_fragment_chars", "max_block_chars", "max_fragment_count")
_SHARES = (
    "min_my_char_ratio",
    "max_short_fragment_ratio",
    "max_chaos_ratio_for_candidate",
    "max_other_char_ratio_inside_my_block",
    "min_surface_overlap",
    "near_duplicate_threshold",
)


def check(s: Settings) -> Settings:
    """``s`` itself, or a ValueError that lists all that is wrong with it."""
    wrong = []
    for f in fields(s):
        value, default = getattr(s, f.name), getattr(CODE_DEFAULTS, f.name, None)
        if default is None:
            continue
        number = isinstance(default, (int, float)) and not isinstance(default, bool)
        if isinstance(default, bool) != isinstance(value, bool) or (number and not isinstance(value, (int, float))):
            wrong.append(f"{f.name}: expected {type(default).__name__}")
        elif isinstance(default, int) and number and not isinstance(value, int) and f.name.endswith(("_count", "_limit", "_chars", "_run", "_n")):
            wrong.append(f"{f.name}: expected a whole number")
        elif number and value < 0:
            wrong.append(f"{f.name}: negative")
        elif f.name in _POSITIVE and value <= 0:
            wrong.append(f"{f.name}: has to be positive")
        elif f.name in _SHARES and not 0 <= value <= 1:
            wrong.append(f"{f.name}: outside 0 to 1")
        elif isinstance(default, tuple) and f.name != "bucket_weight" and not (isinstance(value, tuple) and all(isinstance(x, str) for x in value)):
            wrong.append(f"{f.name}: expected strings")
    if not wrong and s.light_interruption_chars > s.hard_interruption_chars:
        wrong.append("light_interruption_chars: above hard_interruption_chars")
    if s.privacy_mode not in ("strict", "balanced", "recall"):
        wrong.append("privacy_mode: expected strict, balanced or recall")
    if "/" in s.writer_name or "\\" in s.writer_name or ".." in s.writer_name:
        wrong.append("writer_name: expected a plain directory name")
    if wrong:
        raise ValueError("\n".join(wrong))
    return s


def from_mapping(tree: dict[str, Any], base: Settings = CODE_DEFAULTS) -> Settings:
    """Overlay a parsed TOML tree on ``base``."""
    known = {f.name for f in fields(Settings)}
    changes: dict[str, Any] = {}
    unknown: list[str] = []

    def walk(section: str, node: dict[str, Any]) -> None:
        if section == "phrase_mining.bucket_weight":
            changes["bucket_weight"] = tuple((dict(base.bucket_weight) | node).items())
            return
        for key, value in node.items():
            if isinstance(value, dict):
                walk(f"{section}.{key}" if section else key, value)
                continue
            name = _RENAMED.get((section, key), key)
            if name in known:
                changes[name] = tuple(value) if isinstance(value, list) else value
            elif section.split(".")[0] not in _ELSEWHERE and not {(section, key), (section, "*")} & _BESIDES:
                unknown.append(f"{section}.{key}" if section else key)

    walk("", tree)
    if unknown:
        raise ValueError("unknown settings: " + ", ".join(unknown))
    return check(replace(base, **changes))


def from_toml(path: str | Path, base: Settings = CODE_DEFAULTS) -> Settings:
    with open(path, "rb") as f:
        return from_mapping(tomllib.load(f), base)


def paths(tree: dict[str, Any], writer_name: str, root: str | Path) -> dict[str, str]:
    """Folders and files that a settings file names, templates filled in: input, output, decisions, lexicons, archive."""
    lexicons = tree.get("lexicon", {})
    named = {
        "input": tree.get("path", {}).get("input_dir"),
        "output": tree.get("path", {}).get("output_dir"),
        "decisions": tree.get("review", {}).get("decisions_path"),
        "lexicons": lexicons.get("phrase_bank_path", "").rpartition("/")[0],
        "archive": lexicons.get("archive", {}).get("phrase_bank_path", "").rpartition("/")[0],
    }
    return {k: expand(v, writer_name, root) for k, v in named.items() if v}


def snapshot(s: Settings) -> str:
    """The settings as TOML text, for the run folder."""

    def shown(v: Any) -> str:
        if isinstance(v, bool):
            return str(v).lower()
        if isinstance(v, str):
            return '"' + v.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n") + '"'
        if isinstance(v, tuple):
            return "[" + ", ".join(shown(x) for x in v) + "]"
        return repr(v)

    return "".join(f"{f.name} = {shown(getattr(s, f.name))}\n" for f in fields(s))


def expand(path: str, writer_name: str, root: str | Path) -> str:
    """A templated path with ``{writer_name}`` filled in, relative to ``root`` unless absolute."""
    if "{writer_name}" in path and not writer_name:
        raise ValueError(f"{path}: needs a writer name")
    full = path.replace("{writer_name}", writer_name)
    return full if full.startswith("/") or "://" in full else f"{str(root).rstrip('/')}/{full}"


@dataclass(frozen=True)
class Words:
    """The derived word lists of a lexicon, in file order; repeated entries count as often as they come."""

    analysis: tuple[str, ...] = ()
    tone: tuple[str, ...] = ()
    light_interruption: tuple[str, ...] = ()
    argument: tuple[str, ...] = ()
    analysis_tag: tuple[str, ...] = ()
    mild: tuple[str, ...] = ()
    strong: tuple[str, ...] = ()
    high_risk: tuple[str, ...] = ()
    medium_risk: tuple[str, ...] = ()
    drop_sentence: tuple[str, ...] = ()
    mask: tuple[str, ...] = ()
    stoplist: tuple[str, ...] = ()
    manual_keep: tuple[str, ...] = ()
    manual_drop: tuple[str, ...] = ()
    extra: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def promoted(self, phrases: list[str]) -> Words:
        return replace(self, analysis=self.analysis + tuple(phrases))
