"""Fixture inputs, typed in here, and the results worked out for them by hand."""

from __future__ import annotations

import json

VIEWS = {
    "user1": [(1000, "page1"), (1100, "page2"), (2200, "page1"), (2500, "page2"), (2990, "page1")],
    "user2": [
        (4100, "page1"),
        (7102, "page3"),
        (8000, "page3"),
        (8200, "page3"),
        (8300, "page3"),
        (9000, "page3"),
    ],
    "user3": [(6000, "page3"), (7000, "page4")],
    "user4": [(11000, "page3")],
    "user5": [(10000, "page1"), (10020, "page1"), (11000, "page2"), (11900, "page1")],
}
USERS = [
    ("user1", "M", 500, "1"),
    ("user5", "F", 8000, "5"),
    ("user2", "F", 2500, "2"),
    ("user3", "M", 4900, "3"),
    ("user4", "F", 9800, "4"),
]


def view_rows() -> list[tuple]:
    return [(t, user, page) for user, views in VIEWS.items() for t, page in views]


def view_lines() -> list[str]:
    return [json.dumps({"userid": u, "viewtime": t, "pageid": p}) for t, u, p in view_rows()]


def user_lines() -> list[str]:
    return [
        json.dumps({"userid": u, "gender": g, "registertime": t, "regionid": r})
        for u, g, t, r in USERS
    ]


# (gender, window start in seconds, page, total view time, distinct users)
TOTALS = {
    ("F", 0, "page1", 4100, 1),
    ("F", 0, "page3", 40602, 1),
    ("F", 10, "page1", 31920, 1),
    ("F", 10, "page2", 11000, 1),
    ("F", 10, "page3", 11000, 1),
    ("M", 0, "page1", 6190, 1),
    ("M", 0, "page2", 3600, 1),
    ("M", 0, "page3", 6000, 1),
    ("M", 0, "page4", 7000, 1),
}
# (gender, window start, position, page, total view time)
TOP_2_PER_WINDOW = {
    ("F", 0, 1, "page3", 40602),
    ("F", 0, 2, "page1", 4100),
    ("F", 10, 1, "page1", 31920),
    ("F", 10, 2, "page2", 11000),
    ("M", 0, 1, "page4", 7000),
    ("M", 0, 2, "page1", 6190),
}
TOP_2_PER_GENDER = {
    ("F", 0, 1, "page3", 40602),
    ("F", 10, 2, "page1", 31920),
    ("M", 0, 1, "page4", 7000),
    ("M", 0, 2, "page1", 6190),
}
