"""Column -> Column helpers. No function here touches a DataFrame."""
