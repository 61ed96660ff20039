from .geo import cell_of, cell_of_value
from .text import observation_key, season_of, summary_key

__all__ = ["cell_of", "cell_of_value", "observation_key", "season_of", "summary_key"]
