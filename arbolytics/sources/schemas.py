"""Schemas and fixed value lists of the three feeds."""

from __future__ import annotations

from pyspark.sql import types as T

# The sensor metrics of a reading, in record order.
BOOLEAN_METRICS = ["light", "motion"]
NUMERIC_METRICS = ["co", "humidity", "smoke", "temp", "lpg", "soil_ph", "rainfall", "soil_temp",
                   "soil_humidity", "soil_nitrogen", "soil_potassium", "soil_phosporous"]
SENSOR_METRICS = BOOLEAN_METRICS + NUMERIC_METRICS

READING = T.StructType(
    [T.StructField("device_id", T.StringType())]
    + [T.StructField(m, T.BooleanType()) for m in BOOLEAN_METRICS]
    + [T.StructField(m, T.DoubleType()) for m in NUMERIC_METRICS]
    + [T.StructField(c, T.StringType())
       for c in ("garden_id", "garden_name", "location", "species_id", "plant_id", "timestamp")])

# The daily metrics of a forecast.
FORECAST_METRICS = ["temperature_2m_max", "temperature_2m_min", "rain_sum", "showers_sum",
                    "snowfall_sum", "precipitation_probability_max"]

FORECAST_PAYLOAD = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("pr_date", T.StringType()),
    T.StructField("prediction_date", T.StringType()),
    T.StructField("daily", T.StructType([
        T.StructField(m, T.ArrayType(T.DoubleType())) for m in FORECAST_METRICS])),
])

WEATHER = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("pr_date", "prediction_date", "city")]
    + [T.StructField(m, T.DoubleType()) for m in FORECAST_METRICS])

# The trait table's columns, in file order.
TRAIT_TEXT_COLUMNS = [
    "Species_name_standardized_against_TPL", "Taxonomic_level", "Status_according_to_TPL", "Genus",
    "Family", "Phylogenetic_Group_within_angiosperms", "Phylogenetic_Group_General",
    "Adaptation_to_terrestrial_or_aquatic_habitats", "Woodiness", "Growth_Form", "Succulence",
    "Nutrition_type_parasitism", "Nutrition_type_carnivory", "Leaf_type"]
TRAIT_NUMBER_COLUMNS = [
    "Leaf_area_mm2", "Leaf_area_n_o", "Nmass_mg_g", "Nmass_n_o", "LMA_g_m2", "LMA_n_o",
    "Plant_height_m", "Plant_height_n_o", "Diaspore_mass_mg", "Diaspore_mass_n_o",
    "SSD_observed_mg_mm3", "SSD_n_o", "LDMC_g_g", "LDMC_n_o", "SSD_imputed_mg_mm3",
    "SSD_combined_mg_mm3", "Number_of_traits_with_values"]

TRAITS = T.StructType(
    [T.StructField("Species_id", T.IntegerType())]
    + [T.StructField(c, T.StringType()) for c in TRAIT_TEXT_COLUMNS]
    + [T.StructField(c, T.DoubleType()) for c in TRAIT_NUMBER_COLUMNS])
TRAIT_COLUMNS = TRAITS.fieldNames()

# The traits that describe a species in the graph.
GRAPH_TRAITS = [
    "Species_name_standardized_against_TPL", "Taxonomic_level", "Status_according_to_TPL", "Genus",
    "Phylogenetic_Group_within_angiosperms", "Phylogenetic_Group_General",
    "Adaptation_to_terrestrial_or_aquatic_habitats", "Woodiness", "Growth_Form", "Succulence",
    "Nutrition_type_parasitism", "Nutrition_type_carnivory", "Leaf_type", "Leaf_area_mm2",
    "Leaf_area_n_o", "Plant_height_m", "Plant_height_n_o"]

# Plant families and the common names of the species of interest.
FAMILIES = ["Apiaceae", "Amaryllidaceae", "Amaranthaceae", "Brassicaceae", "Compositae",
            "Cucurbitaceae", "Lamiaceae", "Leguminosae", "Rosaceae", "Solanaceae"]
COMMON_NAMES = {
    "Spinacia oleracea": "Spinach",
    "Allium fistulosum": "Green onion/Scallions",
    "Allium sativum": "Garlic",
    "Allium cepa": "Onion",
    "Daucus carota": "Carrot",
    "Petroselinum crispum": "Parsley",
    "Eruca vesicaria": "Arugula",
    "Brassica oleracea": "Kale",
    "Lactuca sativa": "Lettuce",
    "Cucumis sativus": "Cucumber",
    "Basilicum polystachyon": "Basil",
    "Mentha piperita": "Mint",
    "Origanum vulgare": "Oregano",
    "Pisum sativum": "Peas",
    "Phaseolus vulgaris": "Green bean",
    "Fragaria ananassa": "Strawberry",
    "Solanum lycopersicum": "Tomatoes",
    "Solanum melongena": "Eggplant",
    "Capsicum annuum": "Bell pepper",
    "Capsicum chinense": "Chilli pepper",
    "Solanum tuberosum": "Potatoes",
}

# City coordinates (latitude, longitude) for the garden map.
CITY_COORDINATES = {
    "Barcelona": (41.3851, 2.1734),
    "Tarragona": (41.1189, 1.2445),
    "Madrid": (40.4168, -3.7038),
    "Lleida": (41.6177, 0.6200),
    "Girona": (41.9793, 2.8214),
}

# The most plants a device may serve, by garden type.
PLANT_CAPS = {"Big Size Garden": 9, "Middle Size Garden": 4, "Small Garden With Lamp": 4}
