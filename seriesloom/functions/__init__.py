"""Column helpers shared by every index builder."""
