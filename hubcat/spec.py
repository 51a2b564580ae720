"""Schemas, keyword maps and thresholds of the three catalogues."""

from __future__ import annotations

from dataclasses import dataclass

# --------------------------------------------------------------------------
# Column names, size ranges, keyword maps and thresholds that
# decide results. Callers may pass their own instead.
# --------------------------------------------------------------------------

MODEL_COLUMNS = (
    "id", "downloads", "downloadsAllTime", "likes", "pipeline_tag", "tags",
    "safetensors", "lastModified", "createdAt",
)

DATASET_COLUMNS = ("id", "downloads", "downloadsAllTime", "likes", "tags", "lastModified")

PAPER_COLUMNS = (
    "publishedAt", "title", "summary", "thumbnail", "numComments", "submittedBy",
    "organization", "isAuthorParticipating", "mediaUrls", "paper_id", "paper_authors",
    "paper_publishedAt", "paper_submittedOnDailyAt", "paper_title", "paper_summary",
    "paper_upvotes", "paper_discussionId", "paper_ai_summary", "paper_ai_keywords",
    "paper_submittedOnDailyBy._id", "paper_submittedOnDailyBy.avatarUrl",
    "paper_submittedOnDailyBy.isPro", "paper_submittedOnDailyBy.fullname",
    "paper_submittedOnDailyBy.user", "paper_submittedOnDailyBy.type",
    "paper_organization._id", "paper_organization.name", "paper_organization.fullname",
    "paper_organization.avatar", "paper_githubRepo", "paper_githubStars",
    "paper_mediaUrls", "paper_projectPage", "paper_withdrawnAt",
)

TAXONOMY_COLUMNS = (
    "taxonomy_categories", "taxonomy_subcategories", "taxonomy_topics",
    "primary_category", "primary_subcategory", "primary_topic",
    "matched_keywords_details", "category_scores", "subcategory_scores", "topic_scores",
)

# Types of columns that a dump may lack or bring as text. Nested ones that dumps bring in
# several shapes are not named: they pass as they are, and are text when absent.
COLUMN_TYPES = {
    "createdAt": "timestamp", "publishedAt": "timestamp", "paper_publishedAt": "timestamp",
    "paper_submittedOnDailyAt": "timestamp", "paper_withdrawnAt": "timestamp",
    "isAuthorParticipating": "boolean", "paper_submittedOnDailyBy.isPro": "boolean",
    "mediaUrls": "array<string>", "paper_mediaUrls": "array<string>", "paper_ai_keywords": "array<string>",
    "citation_count": "double", "params": "double",
    "taxonomy_categories": "array<string>", "taxonomy_subcategories": "array<string>",
    "taxonomy_topics": "array<string>", "category_scores": "map<string,double>",
    "subcategory_scores": "map<string,double>", "topic_scores": "map<string,double>",
    "data_download_timestamp": "timestamp",
}

# Half-open ranges [low, high) in units of 2^30.
SIZE_RANGES = (
    ("Small (<1GB)", 0.0, 1.0),
    ("Medium (1-5GB)", 1.0, 5.0),
    ("Large (5-20GB)", 5.0, 20.0),
    ("X-Large (20-50GB)", 20.0, 50.0),
    ("XX-Large (>50GB)", 50.0, float("inf")),
)
UNKNOWN_SIZE = "Unknown"
SIZE_DIVISOR = 1073741824.0
NO_ORGANIZATION = "unaffiliated"
TAG_SEPARATOR = "~~~"

MODEL_FLAGS = {
    "has_audio": ("audio",),
    "has_speech": ("speech",),
    "has_music": ("music",),
    "has_robot": ("robot", "robotics", "openvla", "vla"),
    "has_bio": ("bio",),
    "has_med": ("medic", "medical"),
    "has_series": ("series", "time-series", "timeseries"),
    "has_video": ("video",),
    "has_image": ("image", "vision"),
    "has_text": ("text", "nlp", "llm"),
}
DATASET_FLAGS = {**MODEL_FLAGS, "has_robot": ("robot", "robotics")}

MODEL_FINAL = (
    "id", "downloads", "downloadsAllTime", "likes", "pipeline_tag", "tags", "params",
    "size_category", "organization", *MODEL_FLAGS, "has_science", "is_audio_speech",
    "is_biomed", "data_download_timestamp", "createdAt",
)
DATASET_FINAL = (
    "id", "downloads", "downloadsAllTime", "likes", "tags", "organization",
    *DATASET_FLAGS, "has_science", "is_biomed", "data_download_timestamp",
)
PAPER_FINAL = (
    *PAPER_COLUMNS, "data_download_timestamp", "organization_name", "citation_count",
    "semantic_scholar_id", *TAXONOMY_COLUMNS,
)

SIMILARITY_THRESHOLD = 0.55
LABEL_SCORE_SHARE = 0.9
MAX_LABELS = 5

FRESH_DAYS = 7
TITLE_SCORE = 60
MIN_BATCH_ROWS = 200
MAX_BATCH_ROWS = 1000
MAX_BATCHES = 200
MAX_CAPPED_JOBS = 20
SECONDS_PER_ROW = 3
JOBS_PER_WAVE = 15

# ------------------------------------------------------- end of fixed values


@dataclass(frozen=True)
class CatalogSpec:
    """What a raw dump is read for, and what the finished table looks like."""

    name: str
    key: str
    source: tuple[str, ...]          # columns pruned to at the scan
    numeric: tuple[str, ...]         # double, null or junk -> 0.0
    text: tuple[str, ...]            # string, null -> ''
    arrays: tuple[str, ...]          # kept as they are, empty array when absent
    other: tuple[str, ...]           # kept as they are, null when absent
    final: tuple[str, ...]           # ordered output columns
    flag_defaults: bool = True       # absent has_/is_ columns become false

    @property
    def conformed(self) -> tuple[str, ...]:
        kept = set(self.numeric) | set(self.text) | set(self.arrays) | set(self.other)
        return tuple(c for c in self.source if c in kept)


MODELS = CatalogSpec(
    name="models",
    key="id",
    source=MODEL_COLUMNS,
    numeric=("downloads", "downloadsAllTime", "likes"),
    text=("id", "pipeline_tag"),
    arrays=("tags",),
    other=("safetensors", "createdAt"),
    final=MODEL_FINAL,
)

DATASETS = CatalogSpec(
    name="datasets",
    key="id",
    source=DATASET_COLUMNS,
    numeric=("downloads", "downloadsAllTime", "likes"),
    text=("id",),
    arrays=("tags",),
    other=(),
    final=DATASET_FINAL,
)

PAPERS = CatalogSpec(
    name="papers",
    key="paper_id",
    source=PAPER_COLUMNS,
    numeric=("paper_upvotes", "numComments", "paper_githubStars"),
    text=(),
    arrays=(),
    other=tuple(
        c for c in PAPER_COLUMNS
        if c not in ("paper_upvotes", "numComments", "paper_githubStars")
    ),
    final=PAPER_FINAL,
    flag_defaults=False,
)
