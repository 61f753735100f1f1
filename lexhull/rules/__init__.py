"""Default rule tables. Every operator takes its rules as an argument; these are what it takes by default."""
