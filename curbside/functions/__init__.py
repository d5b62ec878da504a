from curbside.functions import calendar, geo, scores

__all__ = ["calendar", "geo", "scores"]
