"""Settings of the jobs, and the values that define the board's page format."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values -----------------------------------------------------------
# These belong to the site and its page layout and must be exactly as given.

SITE_ORIGIN = "https://m.inven.co.kr"
ALLOWED_HOSTS = ("m.inven.co.kr", "www.inven.co.kr", "inven.co.kr")

# Board id -> tags whose first element with class "subject" carries the title,
# in order of preference.
BOARD_LAYOUTS = {
    5861: ("span",),
    5558: ("strong", "span", "div"),
}
SUBJECT_CLASS = "subject"

# Paths that are never followed: three endpoints exactly, and one whole subtree.
DISALLOWED_PATHS = (
    "/board/prevnext.php",
    "/powerbbs/prevnext.php",
    "/webzine/prevnext.php",
)
DISALLOWED_PREFIX = "/staff/"

VIEWS_PREFIX = "조회:"
VOTES_PREFIX = "추천:"
FOOTER_LINES = ("댓글쓰기", "댓글보기", "목록")

HEADER_LINES = 120  # date and author are looked for in this many lines
AUTHOR_MAX_CHARS = 20
PREVIEW_CHARS = 120
PREVIEW_MARK = "…"

LABELS = ("neg", "neu", "pos")  # order of the model's outputs

# Which text of a post is scored.
TEXT_TITLE = "title"
TEXT_TITLE_CONTENT = "title+content"

# Columns of the result tables.
ANALYZED_COLUMNS = (
    "board_id",
    "post_id",
    "url",
    "title",
    "content",
    "author",
    "created_at",
    "crawled_at",
    "sentiment_label",
    "sentiment_score",
    "sentiment_probs",
    "model_version",
    "text_used",
)
PAYLOAD_COLUMNS = (
    "doc_id",
    "board_id",
    "post_id",
    "title",
    "url",
    "sentiment_label",
    "sentiment_score",
    "sentiment_probs",
    "text_used",
    "model_version",
)

# Category before a title: a few characters in brackets.
CATEGORY_PATTERN = r"\[([^\]]{1,6})\]"

# Date and time of a post: day and minutes, and what may follow.
DATE_PATTERN = r"20\d{2}-\d{2}-\d{2}"
MINUTES_PATTERN = r"\d{2}:\d{2}"
SECONDS_PATTERN = r":\d{2}"

# --- Layout helpers ---------------------------------------------------------

# Pseudo tag for boards whose anchors hold the title as plain text.
PLAIN_ANCHOR = "a"


@dataclass(frozen=True)
class BoardConfig:
    """How list and post pages of a site are read."""

    origin: str = SITE_ORIGIN
    allowed_hosts: tuple[str, ...] = ALLOWED_HOSTS
    layouts: dict[int, tuple[str, ...]] = field(default_factory=lambda: dict(BOARD_LAYOUTS))
    max_posts: int | None = None  # references per list page; all if not given
    created_at_seconds: bool = False

    def __post_init__(self) -> None:
        if self.max_posts is not None and self.max_posts < 0:
            raise ValueError("the cap of a list page cannot be negative")



@dataclass(frozen=True)
class ScoringConfig:
    """How posts are scored."""

    model_version: str
    text_used: str = TEXT_TITLE
    batch_size: int = 16
    max_length: int = 256  # tokens of a text that a model sees
    neutral_floor: float = 0.0

    def __post_init__(self) -> None:
        if self.text_used not in (TEXT_TITLE, TEXT_TITLE_CONTENT):
            raise ValueError(f"unknown choice of text: {self.text_used}")
        if self.batch_size <= 0:
            raise ValueError("a batch holds one text at least")
        if self.max_length <= 0:
            raise ValueError("a model sees one token at least")
        if not 0 <= self.neutral_floor <= 1:
            raise ValueError("the floor of a neutral label is a probability")
