"""Plain Python answers for small inputs."""

import math
from collections import defaultdict

RADIUS = 6_371_008.8


def metres(lat1, lon1, lat2, lon2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = (
        math.sin((p2 - p1) / 2) ** 2
        + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    )
    return 2 * RADIUS * math.asin(min(1.0, math.sqrt(a)))


def near(meters, lat, lon, radius):
    """Inventory rows (id, latitude, longitude) in range."""
    return [
        m for m in meters
        if m[1] is not None and m[2] is not None and metres(lat, lon, m[1], m[2]) <= radius
    ]


def mean(values):
    values = list(values)
    return sum(values) / len(values) if values else None


def sessions_per_date(sessions, meters, lat, lon, radius, day, time):
    per_date = defaultdict(int)
    for m in near(meters, lat, lon, radius):
        for s in sessions:
            if s["POST_ID"] == m[0] and s["Day_Of_Week"] == day:
                if s["StartTime"] < time < s["EndTime"]:
                    per_date[s["EventDate"]] += 1
    return dict(per_date)


def meters_per_date(sessions, meters, lat, lon, radius, day, hour):
    ids = {m[0] for m in near(meters, lat, lon, radius)}
    per_date = defaultdict(set)
    for s in sessions:
        if s["POST_ID"] in ids and s["Day_Of_Week"] == day:
            if 9 <= s["start_hour"] <= hour <= s["end_hour"] <= 17:
                per_date[s["EventDate"]].add(s["POST_ID"])
    return {date: len(found) for date, found in per_date.items()}


def days_per_meter(sessions, day, hour):
    dates = defaultdict(set)
    for s in sessions:
        if day in (None, s["Day_Of_Week"]):
            if 9 <= s["start_hour"] <= hour <= s["end_hour"] <= 17:
                dates[s["POST_ID"]].add(s["EventDate"])
    return {meter: len(found) for meter, found in dates.items()}
