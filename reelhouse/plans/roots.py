"""Where the layers of one lakehouse lie."""

from __future__ import annotations

from dataclasses import dataclass

from reelhouse.sources import storage


@dataclass(frozen=True)
class Roots:
    raw: str
    bronze: str
    silver: str
    gold: str
    warehouse: str
    quarantine: str
    marks: str
    lineage: str

    @classmethod
    def under(cls, base: str) -> Roots:
        return cls(
            raw=storage.join(base, "raw_json"),
            bronze=storage.join(base, "bronze"),
            silver=storage.join(base, "silver"),
            gold=storage.join(base, "gold"),
            warehouse=storage.join(base, "warehouse"),
            quarantine=storage.join(base, "quarantine"),
            marks=storage.join(base, "watermark"),
            lineage=storage.join(base, "lineage"),
        )
