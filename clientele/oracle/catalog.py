"""All oracle SQL by query name."""

from __future__ import annotations

from clientele.oracle import core, learning, profiles, reports

ORACLES = {**core.ORACLES, **reports.ORACLES, **profiles.ORACLES, **learning.ORACLES}
