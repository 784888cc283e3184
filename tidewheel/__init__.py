"""DataFrame operators for scaling, search, forecasting, training and prompt scoring."""

from tidewheel.session import get_session, shared_dir, ship

__all__ = ["get_session", "shared_dir", "ship"]
