"""Column functions and the small driver-side maths they need."""
