"""Seller-risk analytics as plain DataFrame-to-DataFrame functions on Spark."""

from sellerlens.policy import RiskPolicy
from sellerlens.session import build_session

__all__ = ["RiskPolicy", "build_session"]
