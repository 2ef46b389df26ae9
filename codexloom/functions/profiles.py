"""Chunking parameters per profile, as a table small enough for any join (12 rows, fixed)."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Profile:
    name: str
    kind: str
    target: int
    max: int
    split: int
    min: int
    overlap: int
    max_level: int | None

    @property
    def heading_detection(self) -> str:
        """The name of the rules that a manifest states (fixed values)."""
        if self.kind == "markdown":
            return f"markdown_heading_{self.name}_v1"
        return f"pdf_outline_first_{'zh_' if self.name in ('social_science', 'textbook') else ''}{self.name}_v1"

    def with_(self, **given: int | None) -> Profile:
        """The profile with what was given in place of its defaults; None keeps the default."""
        return replace(self, **{k: v for k, v in given.items() if v is not None})


# Target, most, split threshold, least and overlap characters, deepest heading level of a chunk.
PROFILES = {
    p.name: p
    for p in (
        Profile("social_science", "book", 800, 1200, 2000, 220, 100, None),
        Profile("textbook", "book", 700, 1100, 2000, 180, 80, 4),
        Profile("technical", "book", 700, 1100, 2000, 180, 80, 4),
        Profile("paper", "book", 700, 1100, 1800, 180, 80, 4),
        Profile("legal", "book", 650, 1000, 1600, 120, 60, 4),
        Profile("english", "book", 900, 1400, 2200, 220, 120, 4),
        Profile("fiction", "book", 1000, 1600, 2400, 260, 160, None),
        Profile("classical", "book", 700, 1100, 2000, 160, 80, 3),
        Profile("reference", "book", 550, 900, 1400, 80, 40, 2),
        Profile("journal", "markdown", 700, 1100, 1800, 120, 80, 4),
        Profile("tech_notes", "markdown", 700, 1100, 2000, 120, 80, 4),
        Profile("web_page_collection", "markdown", 700, 1100, 1800, 120, 80, 4),
    )
}
BOOK_PROFILES = tuple(n for n, p in PROFILES.items() if p.kind == "book")
DEFAULT_EMBEDDING_MODEL = "BAAI/bge-large-zh-v1.5"
#: What a chunker called without a profile uses; the split threshold is then the most.
PLAIN = Profile("plain", "book", 800, 1200, 1200, 220, 100, None)


def profile_table(spark: SparkSession) -> DataFrame:
    rows = [(p.name, p.kind, p.target, p.max, p.split, p.min, p.overlap, p.max_level) for p in PROFILES.values()]
    return spark.createDataFrame(rows, "profile string, kind string, target_chars int, max_chars int, section_split_chars int, min_chunk_chars int, overlap_chars int, max_chunk_heading_level int")
