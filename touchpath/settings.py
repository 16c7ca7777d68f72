"""Vocabulary, thresholds and dates; every operator takes them from here.

Nothing in the library reads the clock: "today" is ``Settings.as_of``.
Literals that belong to one company (account, URL host, white lists, profiles)
are parameters with neutral defaults.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# --- fixed values: labels and lists that results must reproduce exactly ------

# clean activity types
ACTIVITY_TYPES = (
    "Admin.Call",
    "Assisted.Roadshow",
    "Business.Development",
    "Call",
    "Clicked.Email",
    "Client.Services.Call",
    "Conference.Call",
    "Seminar",
    "Seminar.Entertainment",
    "EdForum",
    "Email",
    "HardMail",
    "Inbound",
    "Investor.University",
    "VoiceMail",
    "LitOrder",
    "Marketing.Webinar",
    "Meeting",
    "Opened.Email",
    "Outbound",
    "Sale",
    "Sales.Presentation",
    "Selling.Agreement",
    "Unassisted.Roadshow",
    "Web.Presentation",
    "WebHit",
)

# raw types that never enter an analysis
EXCLUDED_TYPES = ("DD Kit Mailing", "To-Do", "Voicemail", "BD Event", "Bond Deal")

# engagement levels; the position of a label is its code
LEVELS = (
    "PresentDay",
    "New Producer",
    "Rising Star",
    "Developing Producer",
    "Advocate",
    "Core Producer",
    "Level5",
    "Level4",
    "Level3",
    "Level2",
    "Level1",
    "Level0",
)

# contact types that keep a contact at Level1 under the first rule set
LIGHT_TOUCHES = (
    "WebHit",
    "Clicked.Email",
    "Opened.Email",
    "Conference.Call",
    "Client.Services.Call",
    "Seminar",
    "Seminar.Entertainment",
    "Inbound",
    "Admin.Call",
    "Call",
    "Business.Development",
)

# the second rule set lets these decay to Level1 as well
STRONG_TOUCHES = (
    "Outbound",
    "Marketing.Webinar",
    "Sales.Presentation",
    "Assisted.Roadshow",
    "Unassisted.Roadshow",
    "Investor.University",
    "EdForum",
    "Meeting",
    "LitOrder",
)

# next steps offered at each level, most wanted first. "RoadShow" and "Edforum"
# are spelled as the results need them: they match no step counter.
NEXT_STEPS = {
    "Level0": ("Website", "Webinar"),
    "Level1": ("Website", "Webinar", "RoadShow"),
    "Level2": ("Webinar", "Roadshow", "Meeting"),
    "Level3": ("Webinar", "Roadshow", "Meeting"),
    "Level4": ("Roadshow", "Webinar", "Meeting", "EdForum"),
    "Level5": ("Meeting", "EdForum", "Roadshow"),
    "New Producer": ("Webinar", "Meeting", "Roadshow", "Edforum"),
    "Rising Star": ("Webinar", "Meeting", "Roadshow", "Edforum"),
    "Developing Producer": ("Webinar", "Meeting", "Roadshow", "Edforum"),
    "Core Producer": ("Webinar", "Meeting", "Roadshow", "Edforum"),
    "Advocate": ("Webinar", "Meeting", "Roadshow", "Edforum"),
}

# step -> (activity types counted, days looked back)
STEP_WINDOWS = {
    "Website": (("WebHit",), 21),
    "Webinar": (("Marketing.Webinar",), 35),
    "Roadshow": (("Assisted.Roadshow", "Unassisted.Roadshow"), 180),
    "Meeting": (("Meeting",), 180),
    "EdForum": (("EdForum",), 540),
}

# types listed in a contact's activity description ("Edforum" as is)
DESCRIBED_TYPES = (
    "Selling.Agreement",
    "Assisted.Roadshow",
    "Business.Development",
    "Client.Services.Call",
    "Conference.Call",
    "Seminar",
    "Edforum",
    "Investor.University",
    "LitOrder",
    "Marketing.Webinar",
    "Opened.Email",
    "Unassisted.Roadshow",
    "WebHit",
)

# raw task types of sales personnel and their clean names
PERSONNEL_TYPES = {
    "Left Voicemail/Message with Assistant": "VoiceMail",
    "Meeting": "Meeting",
    "Outbound": "Outbound",
    "Sales Presentation": "Sales.Presentation",
}

# --- end of fixed values ------------------------------------------------------

DEMOGRAPHICS = ("gdc", "aum", "x_to_advisory", "x_to_alternatives", "age")


def _spaced_names() -> dict[str, str]:
    """Raw spelling (words apart) -> clean name (words joined by dots)."""
    return {name.replace(".", " "): name for name in ACTIVITY_TYPES}


@dataclass(frozen=True)
class Settings:
    """Dates, thresholds and vocabulary of one run."""

    as_of: dt.date
    # fixed values: floors and spans that results must reproduce exactly
    year_floor: dt.date = dt.date(2012, 1, 1)  # activities on or after
    feature_floor: dt.date = dt.date(2013, 12, 31)  # features after
    training_floor: dt.date = dt.date(2014, 12, 31)  # training rows after
    score_floor: dt.date = dt.date(2016, 3, 1)  # score timeline on or after
    personnel_floor: dt.date = dt.date(2014, 12, 31)  # personnel actions after
    label_days: int = 35
    recent_days: int = 21
    timeline_rows: int = 15
    # end of fixed values
    type_names: dict[str, str] = field(default_factory=_spaced_names)
    excluded_types: tuple[str, ...] = EXCLUDED_TYPES
    learn_pattern: str = "www.example.com/learn"
    investments_pattern: str = "www.example.com/investments"
    next_steps: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(NEXT_STEPS))
    described_types: tuple[str, ...] = DESCRIBED_TYPES
    excluded_account: str = "HOUSE"
    content_host: str = "example"
    profiles: tuple[str, ...] = ("Broker Desk", "Adviser Desk", "Broker Associate", "Adviser Associate")
    draw_seed: str = "123"
    # a contact with more activities than this is spread over several tasks
    rows_per_task: int = 1_000_000
    # rows of the log, where they are known: it is then dealt over as many tasks as they need
    log_rows: int | None = None


@dataclass(frozen=True)
class ModelSettings:
    """Boosted-tree parameters (the defaults are the second model's; the first one's trees are 10 deep)."""

    # fixed values: the parameters of the model that results follow
    rounds: int = 10_000
    step_size: float = 0.001
    max_depth: int = 11
    subsample: float = 0.9
    seed: int = 123
