"""Feature catalogues: named groups of feature columns in a fixed order."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Feature:
    group_id: str
    group_label: str
    display: str
    column: str


@dataclass(frozen=True)
class Resolved:
    """Columns a table offers for a request, and the requested ones it lacks."""

    columns: tuple[str, ...]
    missing: tuple[str, ...]


_SCHEMA = T.StructType(
    [
        T.StructField("catalog", T.StringType(), False),
        T.StructField("group_id", T.StringType(), False),
        T.StructField("group_label", T.StringType(), False),
        T.StructField("group_ord", T.IntegerType(), False),
        T.StructField("display", T.StringType(), False),
        T.StructField("column", T.StringType(), False),
        T.StructField("ord", T.IntegerType(), False),
    ]
)


@dataclass(frozen=True)
class FeatureCatalog:
    name: str
    features: tuple[Feature, ...]
    defaults: tuple[str, ...] = ()

    @classmethod
    def of(
        cls, name: str, groups: dict[str, Sequence[str]], defaults: Sequence[str] = ()
    ) -> FeatureCatalog:
        """Catalogue whose labels and display names equal the ids and columns."""
        return cls(
            name,
            tuple(Feature(g, g, c, c) for g, cols in groups.items() for c in cols),
            tuple(defaults),
        )

    @property
    def groups(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(f.group_id for f in self.features))

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(f.column for f in self.features))

    def group_columns(self, group_id: str) -> tuple[str, ...]:
        found = tuple(f.column for f in self.features if f.group_id == group_id)
        if not found:
            raise ValueError(f"catalogue {self.name!r} has no group {group_id!r}")
        return found

    def to_df(self, spark: SparkSession) -> DataFrame:
        position = {g: i for i, g in enumerate(self.groups)}
        rows = [
            (self.name, f.group_id, f.group_label, position[f.group_id], f.display, f.column, i)
            for i, f in enumerate(self.features)
        ]
        return spark.createDataFrame(rows, _SCHEMA)

    def resolve(
        self,
        available: Iterable[str],
        columns: Iterable[str] | None = None,
        groups: Iterable[str] | None = None,
        all_: bool = False,
        exclude_columns: Iterable[str] = (),
        exclude_groups: Iterable[str] = (),
    ) -> Resolved:
        """Requested features in catalogue order, restricted to ``available``.

        With no request at all the catalogue's defaults are taken. Exclusions are
        applied last, which is how a group or a single feature is switched off.
        A name outside the catalogue is ignored.
        """
        if all_:
            wanted = set(self.columns)
        elif columns is None and groups is None:
            wanted = set(self.defaults)
        else:
            wanted = set(columns or ())
            for group in groups or ():
                wanted.update(self.group_columns(group))
        wanted.difference_update(exclude_columns)
        for group in exclude_groups:
            wanted.difference_update(self.group_columns(group))
        have = set(available)
        chosen = [c for c in self.columns if c in wanted]
        return Resolved(
            tuple(c for c in chosen if c in have), tuple(c for c in chosen if c not in have)
        )


# Group id, group label, display name, column.
_SAMPLE_ROWS = (
    ("index", "Index Features", "A", "index_A"),
    ("index", "Index Features", "Index B", "index_B"),
    ("index", "Index Features", "Norm A", "index_A_norm"),
    ("index", "Index Features", "Norm B", "index_B_norm"),
    ("index", "Index Features", "Max", "index_max"),
    ("index", "Index Features", "Min", "index_min"),
    ("index", "Index Features", "Average", "index_avg"),
    ("atomic_weight", "Atomic Weight", "Weighted A+B", "atomic_weight_A+B_weighted"),
    ("atomic_weight", "Atomic Weight", "A/B", "atomic_weight_A/B"),
    ("atomic_weight", "Atomic Weight", "A-B", "atomic_weight_A-B"),
    ("period_group", "Period & Group", "Period A", "period_A"),
    ("period_group", "Period & Group", "Period B", "period_B"),
    ("period_group", "Period & Group", "Group A", "group_A"),
    ("period_group", "Period & Group", "Group B", "group_B"),
    ("period_group", "Period & Group", "Group A-B", "group_A-B"),
    ("mendeleev", "Mendeleev Numbers", "A", "Mendeleev_number_A"),
    ("mendeleev", "Mendeleev Numbers", "B", "Mendeleev_number_B"),
    ("mendeleev", "Mendeleev Numbers", "A-B", "Mendeleev_number_A-B"),
    ("valence", "Valence Electrons", "A", "valencee_total_A"),
    ("valence", "Valence Electrons", "B", "valencee_total_B"),
    ("valence", "Valence Electrons", "A-B", "valencee_total_A-B"),
    ("valence", "Valence Electrons", "A+B", "valencee_total_A+B"),
    ("valence", "Valence Electrons", "Weighted A+B", "valencee_total_A+B_weighted"),
    ("valence", "Valence Electrons", "Norm Weighted A+B", "valencee_total_A+B_weighted_norm"),
    ("unpaired", "Unpaired Electrons", "A", "unpaired_electrons_A"),
    ("unpaired", "Unpaired Electrons", "B", "unpaired_electrons_B"),
    ("unpaired", "Unpaired Electrons", "A-B", "unpaired_electrons_A-B"),
    ("unpaired", "Unpaired Electrons", "A+B", "unpaired_electrons_A+B"),
    ("unpaired", "Unpaired Electrons", "Weighted A+B", "unpaired_electrons_A+B_weighted"),
    ("unpaired", "Unpaired Electrons", "Norm Weighted A+B", "unpaired_electrons_A+B_weighted_norm"),
    ("gilman", "Gilman", "A", "Gilman_A"),
    ("gilman", "Gilman", "B", "Gilman_B"),
    ("gilman", "Gilman", "A-B", "Gilman_A-B"),
    ("gilman", "Gilman", "A+B", "Gilman_A+B"),
    ("gilman", "Gilman", "Weighted A+B", "Gilman_A+B_weighted"),
    ("gilman", "Gilman", "Norm Weighted A+B", "Gilman_A+B_weighted_norm"),
    ("z_eff", "Effective Nuclear Charge", "A", "Z_eff_A"),
    ("z_eff", "Effective Nuclear Charge", "B", "Z_eff_B"),
    ("z_eff", "Effective Nuclear Charge", "A-B", "Z_eff_A-B"),
    ("z_eff", "Effective Nuclear Charge", "A/B", "Z_eff_A/B"),
    ("z_eff", "Effective Nuclear Charge", "Max", "Z_eff_max"),
    ("z_eff", "Effective Nuclear Charge", "Min", "Z_eff_min"),
    ("z_eff", "Effective Nuclear Charge", "Avg", "Z_eff_avg"),
    ("z_eff", "Effective Nuclear Charge", "Norm Weighted A+B", "Z_eff_A+B_weighted_norm"),
    ("ionization_energy", "Ionization Energy", "A", "ionization_energy_A"),
    ("ionization_energy", "Ionization Energy", "B", "ionization_energy_B"),
    ("ionization_energy", "Ionization Energy", "A-B", "ionization_energy_A-B"),
    ("ionization_energy", "Ionization Energy", "A/B", "ionization_energy_A/B"),
    ("ionization_energy", "Ionization Energy", "Max", "ionization_energy_max"),
    ("ionization_energy", "Ionization Energy", "Min", "ionization_energy_min"),
    ("ionization_energy", "Ionization Energy", "Avg", "ionization_energy_avg"),
    ("ionization_energy", "Ionization Energy", "Norm Weighted A+B", "ionization_energy_A+B_weighted_norm"),
    ("coordination_number", "Coordination Number", "A", "coordination_number_A"),
    ("coordination_number", "Coordination Number", "B", "coordination_number_B"),
    ("coordination_number", "Coordination Number", "A-B", "coordination_number_A-B"),
    ("ratio_closest", "Ratio Closest", "A", "ratio_closest_A"),
    ("ratio_closest", "Ratio Closest", "B", "ratio_closest_B"),
    ("ratio_closest", "Ratio Closest", "Max", "ratio_closest_max"),
    ("ratio_closest", "Ratio Closest", "Min", "ratio_closest_min"),
    ("ratio_closest", "Ratio Closest", "Avg", "ratio_closest_avg"),
    ("polyhedron_distortion", "Polyhedron Distortion", "A", "polyhedron_distortion_A"),
    ("polyhedron_distortion", "Polyhedron Distortion", "B", "polyhedron_distortion_B"),
    ("polyhedron_distortion", "Polyhedron Distortion", "Max", "polyhedron_distortion_max"),
    ("polyhedron_distortion", "Polyhedron Distortion", "Min", "polyhedron_distortion_min"),
    ("polyhedron_distortion", "Polyhedron Distortion", "Avg", "polyhedron_distortion_avg"),
    ("cif_radius", "CIF Radius", "A", "CIF_radius_A"),
    ("cif_radius", "CIF Radius", "B", "CIF_radius_B"),
    ("cif_radius", "CIF Radius", "A/B", "CIF_radius_A/B"),
    ("cif_radius", "CIF Radius", "A-B", "CIF_radius_A-B"),
    ("cif_radius", "CIF Radius", "Avg", "CIF_radius_avg"),
    ("cif_radius", "CIF Radius", "Norm Weighted A+B", "CIF_radius_A+B_weighted_norm"),
    ("pauling_radius_cn12", "Pauling Radius (CN12)", "A", "Pauling_radius_CN12_A"),
    ("pauling_radius_cn12", "Pauling Radius (CN12)", "B", "Pauling_radius_CN12_B"),
    ("pauling_radius_cn12", "Pauling Radius (CN12)", "A-B", "Pauling_radius_CN12_A-B"),
    ("pauling_radius_cn12", "Pauling Radius (CN12)", "A/B", "Pauling_radius_CN12_A/B"),
    ("pauling_radius_cn12", "Pauling Radius (CN12)", "Avg", "Pauling_radius_CN12_avg"),
    ("pauling_radius_cn12", "Pauling Radius (CN12)", "Norm Weighted A+B", "Pauling_radius_CN12_A+B_weighted_norm"),
    ("pauling_en", "Pauling Electronegativity", "A", "Pauling_EN_A"),
    ("pauling_en", "Pauling Electronegativity", "B", "Pauling_EN_B"),
    ("pauling_en", "Pauling Electronegativity", "A-B", "Pauling_EN_A-B"),
    ("pauling_en", "Pauling Electronegativity", "A/B", "Pauling_EN_A/B"),
    ("pauling_en", "Pauling Electronegativity", "Max", "Pauling_EN_max"),
    ("pauling_en", "Pauling Electronegativity", "Min", "Pauling_EN_min"),
    ("pauling_en", "Pauling Electronegativity", "Avg", "Pauling_EN_avg"),
    ("pauling_en", "Pauling Electronegativity", "Norm Weighted A+B", "Pauling_EN_A+B_weighted_norm"),
    ("martynov_batsanov_en", "Martynov–Batsanov EN", "A", "Martynov_Batsanov_EN_A"),
    ("martynov_batsanov_en", "Martynov–Batsanov EN", "B", "Martynov_Batsanov_EN_B"),
    ("martynov_batsanov_en", "Martynov–Batsanov EN", "A-B", "Martynov_Batsanov_EN_A-B"),
    ("martynov_batsanov_en", "Martynov–Batsanov EN", "A/B", "Martynov_Batsanov_EN_A/B"),
    ("martynov_batsanov_en", "Martynov–Batsanov EN", "Max", "Martynov_Batsanov_EN_max"),
    ("martynov_batsanov_en", "Martynov–Batsanov EN", "Min", "Martynov_Batsanov_EN_min"),
    ("martynov_batsanov_en", "Martynov–Batsanov EN", "Avg", "Martynov_Batsanov_EN_avg"),
    ("martynov_batsanov_en", "Martynov–Batsanov EN", "Norm Weighted A+B", "Martynov_Batsanov_EN_A+B_weighted_norm"),
    ("melting_point", "Melting Point (K)", "A", "melting_point_K_A"),
    ("melting_point", "Melting Point (K)", "B", "melting_point_K_B"),
    ("melting_point", "Melting Point (K)", "A-B", "melting_point_K_A-B"),
    ("melting_point", "Melting Point (K)", "A/B", "melting_point_K_A/B"),
    ("melting_point", "Melting Point (K)", "Max", "melting_point_K_max"),
    ("melting_point", "Melting Point (K)", "Min", "melting_point_K_min"),
    ("melting_point", "Melting Point (K)", "Avg", "melting_point_K_avg"),
    ("melting_point", "Melting Point (K)", "Norm Weighted A+B", "melting_point_K_A+B_weighted_norm"),
    ("density", "Density", "A", "density_A"),
    ("density", "Density", "B", "density_B"),
    ("density", "Density", "A-B", "density_A-B"),
    ("density", "Density", "A/B", "density_A/B"),
    ("density", "Density", "Max", "density_max"),
    ("density", "Density", "Min", "density_min"),
    ("density", "Density", "Avg", "density_avg"),
    ("density", "Density", "Norm Weighted A+B", "density_A+B_weighted_norm"),
    ("specific_heat", "Specific Heat", "A", "specific_heat_A"),
    ("specific_heat", "Specific Heat", "B", "specific_heat_B"),
    ("specific_heat", "Specific Heat", "A-B", "specific_heat_A-B"),
    ("specific_heat", "Specific Heat", "A/B", "specific_heat_A/B"),
    ("specific_heat", "Specific Heat", "Max", "specific_heat_max"),
    ("specific_heat", "Specific Heat", "Min", "specific_heat_min"),
    ("specific_heat", "Specific Heat", "Avg", "specific_heat_avg"),
    ("specific_heat", "Specific Heat", "Norm Weighted A+B", "specific_heat_A+B_weighted_norm"),
    ("cohesive_energy", "Cohesive Energy", "A", "cohesive_energy_A"),
    ("cohesive_energy", "Cohesive Energy", "B", "cohesive_energy_B"),
    ("cohesive_energy", "Cohesive Energy", "A-B", "cohesive_energy_A-B"),
    ("cohesive_energy", "Cohesive Energy", "A/B", "cohesive_energy_A/B"),
    ("cohesive_energy", "Cohesive Energy", "Max", "cohesive_energy_max"),
    ("cohesive_energy", "Cohesive Energy", "Min", "cohesive_energy_min"),
    ("cohesive_energy", "Cohesive Energy", "Avg", "cohesive_energy_avg"),
    ("cohesive_energy", "Cohesive Energy", "Norm Weighted A+B", "cohesive_energy_A+B_weighted_norm"),
    ("bulk_modulus", "Bulk Modulus", "A", "bulk_modulus_A"),
    ("bulk_modulus", "Bulk Modulus", "B", "bulk_modulus_B"),
    ("bulk_modulus", "Bulk Modulus", "A-B", "bulk_modulus_A-B"),
    ("bulk_modulus", "Bulk Modulus", "A/B", "bulk_modulus_A/B"),
    ("bulk_modulus", "Bulk Modulus", "Max", "bulk_modulus_max"),
    ("bulk_modulus", "Bulk Modulus", "Min", "bulk_modulus_min"),
    ("bulk_modulus", "Bulk Modulus", "Avg", "bulk_modulus_avg"),
    ("bulk_modulus", "Bulk Modulus", "Norm Weighted A+B", "bulk_modulus_A+B_weighted_norm"),
)

# Sample features chosen at the start.
SAMPLE_DEFAULTS = ("atomic_weight_A+B_weighted", "Pauling_radius_CN12_A/B")

# Group id, group label, display name, column.
_ENTITY_ROWS = (
    ("basic_atomic_properties", "Basic Atomic Properties", "Atomic weight", "Atomic weight"),
    ("basic_atomic_properties", "Basic Atomic Properties", "Atomic number", "Atomic number"),
    ("basic_atomic_properties", "Basic Atomic Properties", "Period", "Period"),
    ("basic_atomic_properties", "Basic Atomic Properties", "Group", "Group"),
    ("basic_atomic_properties", "Basic Atomic Properties", "Families", "Families"),
    ("atomic_and_ionic_radii", "Atomic & Ionic Radii", "Atomic radius calculated", "Atomic radius calculated"),
    ("atomic_and_ionic_radii", "Atomic & Ionic Radii", "Covalent radius", "Covalent radius"),
    ("atomic_and_ionic_radii", "Atomic & Ionic Radii", "Ionic radius", "Ionic radius"),
    ("atomic_and_ionic_radii", "Atomic & Ionic Radii", "Effective ionic radius", "Effective ionic radius"),
    ("atomic_and_ionic_radii", "Atomic & Ionic Radii", "Miracle radius", "Miracle radius"),
    ("atomic_and_ionic_radii", "Atomic & Ionic Radii", "van der Waals radius", "van der Waals radius"),
    ("atomic_and_ionic_radii", "Atomic & Ionic Radii", "Zunger radii sum", "Zunger radii sum"),
    ("atomic_and_ionic_radii", "Atomic & Ionic Radii", "Crystal radius", "Crystal radius"),
    ("atomic_and_ionic_radii", "Atomic & Ionic Radii", "Covalent CSD radius", "Covalent CSD radius"),
    ("atomic_and_ionic_radii", "Atomic & Ionic Radii", "Slater radius", "Slater radius"),
    ("atomic_and_ionic_radii", "Atomic & Ionic Radii", "Orbital radius", "Orbital radius"),
    ("atomic_and_ionic_radii", "Atomic & Ionic Radii", "Polarizability", "polarizability, A^3"),
    ("atomic_and_ionic_radii", "Atomic & Ionic Radii", "1st Bohr radius", "1st Bohr radius (a0)"),
    ("electronegativity_and_electron_affinity", "Electronegativity & Electron Affinity", "Ionization energy", "Ionization energy (eV)"),
    ("electronegativity_and_electron_affinity", "Electronegativity & Electron Affinity", "Electron affinity", "Electron affinity (ev)"),
    ("electronegativity_and_electron_affinity", "Electronegativity & Electron Affinity", "Pauling EN", "Pauling EN"),
    ("electronegativity_and_electron_affinity", "Electronegativity & Electron Affinity", "Martynov-Batsanov EN", "Martynov Batsanov EN"),
    ("electronegativity_and_electron_affinity", "Electronegativity & Electron Affinity", "Mulliken EN", "Mulliken EN"),
    ("electronegativity_and_electron_affinity", "Electronegativity & Electron Affinity", "Allred EN", "Allred EN"),
    ("electronegativity_and_electron_affinity", "Electronegativity & Electron Affinity", "Allred-Rockow EN", "Allred Rockow EN"),
    ("electronegativity_and_electron_affinity", "Electronegativity & Electron Affinity", "Nagle EN", "Nagle EN"),
    ("electronegativity_and_electron_affinity", "Electronegativity & Electron Affinity", "Ghosh EN", "Ghosh EN"),
    ("thermal_and_physical_properties", "Thermal & Physical Properties", "Melting point", "Melting point, K"),
    ("thermal_and_physical_properties", "Thermal & Physical Properties", "Boiling point", "Boiling point, K"),
    ("thermal_and_physical_properties", "Thermal & Physical Properties", "Density", "Density,  g/mL"),
    ("thermal_and_physical_properties", "Thermal & Physical Properties", "Specific heat", "Specific heat, J/g K"),
    ("thermal_and_physical_properties", "Thermal & Physical Properties", "Heat of fusion", "Heat of fusion,  kJ/mol"),
    ("thermal_and_physical_properties", "Thermal & Physical Properties", "Heat of vaporization", "Heat of vaporization,  kJ/mol"),
    ("thermal_and_physical_properties", "Thermal & Physical Properties", "Heat of atomization", "Heat of atomization,  kJ/mol"),
    ("thermal_and_physical_properties", "Thermal & Physical Properties", "Thermal conductivity", "Thermal conductivity, W/m K"),
    ("thermal_and_physical_properties", "Thermal & Physical Properties", "Cohesive energy", "Cohesive  energy"),
    ("thermal_and_physical_properties", "Thermal & Physical Properties", "Bulk modulus", "Bulk modulus, GPa"),
    ("electronic_structure", "Electronic Structure", "Mendeleev number", "Mendeleev number"),
    ("electronic_structure", "Electronic Structure", "Quantum number l", "quantum  number l"),
    ("electronic_structure", "Electronic Structure", "Valence s", "valence s"),
    ("electronic_structure", "Electronic Structure", "Valence p", "valence p"),
    ("electronic_structure", "Electronic Structure", "Valence d", "valence d"),
    ("electronic_structure", "Electronic Structure", "Valence f", "valence f"),
    ("electronic_structure", "Electronic Structure", "Unfilled s", "unfilled s"),
    ("electronic_structure", "Electronic Structure", "Unfilled p", "unfilled p"),
    ("electronic_structure", "Electronic Structure", "Unfilled d", "unfilled d"),
    ("electronic_structure", "Electronic Structure", "Onfilled f", "unfilled f"),
    ("electronic_structure", "Electronic Structure", "Valence electrons", "no. of  valence  electrons"),
    ("electronic_structure", "Electronic Structure", "Outer shell electrons", "outer shell electrons"),
    ("electronic_structure", "Electronic Structure", "Gilman valence electrons", "Gilman no. of valence electrons"),
    ("electronic_structure", "Electronic Structure", "Metallic valence", "Metallic  valence"),
    ("electronic_structure", "Electronic Structure", "Zeff", "Zeff"),
    ("dft_lsd_and_lda_properties", "DFT LSD & LDA Properties", "DFT LDA Etot", "DFT LDA Etot"),
    ("dft_lsd_and_lda_properties", "DFT LSD & LDA Properties", "DFT LDA Ekin", "DFT LDA Ekin"),
    ("dft_lsd_and_lda_properties", "DFT LSD & LDA Properties", "DFT LDA Ecoul", "DFT LDA Ecoul"),
    ("dft_lsd_and_lda_properties", "DFT LSD & LDA Properties", "DFT LDA Eenuc", "DFT LDA Eenuc"),
    ("dft_lsd_and_lda_properties", "DFT LSD & LDA Properties", "DFT LDA Exc", "DFT LDA Exc"),
    ("dft_lsd_and_lda_properties", "DFT LSD & LDA Properties", "DFT LSD Etot", "DFT LSD Etot"),
    ("dft_lsd_and_lda_properties", "DFT LSD & LDA Properties", "DFT LSD Ekin", "DFT LSD Ekin"),
    ("dft_lsd_and_lda_properties", "DFT LSD & LDA Properties", "DFT LSD Ecoul", "DFT LSD Ecoul"),
    ("dft_lsd_and_lda_properties", "DFT LSD & LDA Properties", "DFT LSD Eenuc", "DFT LSD Eenuc"),
    ("dft_lsd_and_lda_properties", "DFT LSD & LDA Properties", "DFT LSD Exc", "DFT LSD Exc"),
    ("dft_rlda_and_scrlda_properties", "DFT RLDA & ScRLDA Properties", "DFT RLDA Etot", "DFT RLDA Etot"),
    ("dft_rlda_and_scrlda_properties", "DFT RLDA & ScRLDA Properties", "DFT RLDA Ekin", "DFT RLDA Ekin"),
    ("dft_rlda_and_scrlda_properties", "DFT RLDA & ScRLDA Properties", "DFT RLDA Ecoul", "DFT RLDA Ecoul"),
    ("dft_rlda_and_scrlda_properties", "DFT RLDA & ScRLDA Properties", "DFT RLDA Eenuc", "DFT RLDA Eenuc"),
    ("dft_rlda_and_scrlda_properties", "DFT RLDA & ScRLDA Properties", "DFT RLDA Exc", "DFT RLDA Exc"),
    ("dft_rlda_and_scrlda_properties", "DFT RLDA & ScRLDA Properties", "DFT ScRLDA Etot", "DFT ScRLDA Etot"),
    ("dft_rlda_and_scrlda_properties", "DFT RLDA & ScRLDA Properties", "DFT ScRLDA Ekin", "DFT ScRLDA Ekin"),
    ("dft_rlda_and_scrlda_properties", "DFT RLDA & ScRLDA Properties", "DFT ScRLDA Ecoul", "DFT ScRLDA Ecoul"),
    ("dft_rlda_and_scrlda_properties", "DFT RLDA & ScRLDA Properties", "DFT ScRLDA Eenuc", "DFT ScRLDA Eenuc"),
    ("dft_rlda_and_scrlda_properties", "DFT RLDA & ScRLDA Properties", "DFT ScRLDA Exc", "DFT ScRLDA Exc"),
)

# Entity features chosen at the start.
ENTITY_DEFAULTS = ("Period", "Group")

SAMPLE_CATALOG = FeatureCatalog("samples", tuple(Feature(*row) for row in _SAMPLE_ROWS), SAMPLE_DEFAULTS)
ENTITY_CATALOG = FeatureCatalog("entities", tuple(Feature(*row) for row in _ENTITY_ROWS), ENTITY_DEFAULTS)
