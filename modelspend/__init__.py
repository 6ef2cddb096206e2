"""What SQL models cost to run, and what reusing them saves."""

from modelspend.config import Rates, Settings, Sources, session_settings

__all__ = ["Rates", "Settings", "Sources", "session_settings"]
