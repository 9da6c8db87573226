"""Comparison of observed shop prices with agreed floor prices, as Spark jobs."""

from floorwatch.config import ChannelConfig, Period, RetailerConfig
from floorwatch.plans.channel import ChannelResult, build_channel, run_channel
from floorwatch.plans.channels import CHANNELS

__all__ = [
    "CHANNELS",
    "ChannelConfig",
    "ChannelResult",
    "Period",
    "RetailerConfig",
    "build_channel",
    "run_channel",
]
