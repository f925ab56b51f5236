"""Corpus profiles: how each supported crawl marks its records."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Profile:
    """The version line that opens a record, and the header that names it."""

    name: str
    version: str
    id_field: str


# Record version and id header of each corpus.
PROFILES = {
    "clueweb09": Profile("clueweb09", "WARC/0.18", "WARC-TREC-ID"),
    "clueweb12": Profile("clueweb12", "WARC/1.0", "WARC-TREC-ID"),
    "commoncrawl": Profile("commoncrawl", "WARC/1.0", "WARC-Record-ID"),
}


def get_profile(profile: str | Profile) -> Profile:
    """Resolve a profile by name; unknown names list what is supported."""
    if isinstance(profile, Profile):
        return profile
    try:
        return PROFILES[profile]
    except KeyError:
        supported = ", ".join(PROFILES)
        raise ValueError(f"unknown corpus profile {profile!r}; supported: {supported}") from None
