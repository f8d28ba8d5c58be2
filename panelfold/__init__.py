"""panelfold: DataFrame operators for entity x period panels held in a star schema."""

from panelfold.session import build_session, scratch_dir, stage

__all__ = ["build_session", "scratch_dir", "stage"]
