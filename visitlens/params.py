"""Task parameters of the session and page jobs."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields


def _list(text: str | None) -> list[str]:
    if text is None:
        return []
    return [item.strip() for item in str(text).split(",") if item.strip() != ""]


@dataclass(frozen=True)
class TaskParams:
    """Filter parameters. An empty string (or None) means "not set".

    Dates are inclusive ``yyyy-MM-dd`` strings. List parameters are comma
    separated text, as in the reference's JSON task object.
    """

    start_date: str = "2024-01-01"
    end_date: str = "2024-01-30"
    start_age: int | None = 20
    end_age: int | None = 50
    professionals: str = ""
    cities: str = ""
    sex: str = ""
    keywords: str = ""
    category_ids: str = ""
    target_page_flow: str = "1,2,3,4,5,6,7"
    extra: dict = field(default_factory=dict, compare=False)

    # JSON key of the reference task object -> our field name
    _KEYS = {
        "startDate": "start_date", "endDate": "end_date",
        "startAge": "start_age", "endAge": "end_age",
        "professionals": "professionals", "cities": "cities", "sex": "sex",
        "keywords": "keywords", "categoryIds": "category_ids",
        "targetPageFlow": "target_page_flow",
    }

    @classmethod
    def from_dict(cls, obj: dict) -> "TaskParams":
        names = {f.name for f in fields(cls)}
        kwargs = {}
        for key, value in obj.items():
            name = cls._KEYS.get(key, key)
            if name in names:
                kwargs[name] = value
        for age in ("start_age", "end_age"):
            if age in kwargs:
                value = kwargs[age]
                kwargs[age] = None if value in ("", None) else int(value)
        return cls(**kwargs)

    @classmethod
    def from_json(cls, text: str) -> "TaskParams":
        return cls.from_dict(json.loads(text))

    def list_of(self, name: str) -> list[str]:
        return _list(getattr(self, name))

    def days_in_range(self) -> int | None:
        """Number of days between the inclusive dates; None when open."""
        import datetime as dt
        if not self.start_date or not self.end_date:
            return None
        return (dt.date.fromisoformat(self.end_date) - dt.date.fromisoformat(self.start_date)).days + 1

    def page_flow(self) -> list[int]:
        return [int(p) for p in _list(self.target_page_flow)]
