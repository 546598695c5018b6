"""Part of the paceline operator library."""
