"""DataFrame -> DataFrame operators. Learned state (categories, medians, column
order) is small and explicit; everything else stays lazy."""
