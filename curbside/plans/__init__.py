from curbside.plans.session import build_session
from curbside.plans.settle import settle

__all__ = ["build_session", "settle"]
