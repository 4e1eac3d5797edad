"""Cut a long plan by writing its result to the cluster's shared folder."""

from ..saving import SETTING, clear, new_folder, saved, saved_and_counted, shared_folder

__all__ = ["SETTING", "clear", "new_folder", "saved", "saved_and_counted", "shared_folder"]
